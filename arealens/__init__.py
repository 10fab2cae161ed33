"""Regional emissions and health statistics as lazy Spark DataFrames.

The package is layered the way data flows:

* ``arealens.functions`` - Column expressions (codes, ICD-10, gases, rates, exact sums);
* ``arealens.sources``   - readers for the raw layouts and the Parquet sinks;
* ``arealens.operators`` - reusable DataFrame steps (unpivot, keep-first, dense ids, top-n, sets);
* ``arealens.plans``     - the products: tidy tables, curated table, star schema, query packs.

Every public function takes and returns lazy DataFrames; only the sinks and the
session workspace run Spark jobs.
"""

__version__ = "0.1.0"
