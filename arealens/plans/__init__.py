"""The products: tidy tables, curated table, star schema, checks, profiles and query packs."""
