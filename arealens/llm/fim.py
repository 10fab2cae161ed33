"""Fill-in-the-middle: a text becomes prefix, middle and suffix, written in PSM or SPM order.

The cut runs as a pyarrow.compute pipeline over each Arrow batch, without a Python loop over rows:

1. split: the UTF-8 bytes of all texts of a batch are cut into code points without a copy (a unit starts
   at every byte that is not a continuation byte), which gives one list array of units per text;
2. flatten the lists with their parent indices and compute each unit's ordinal inside its text;
3. give each unit its role (prefix, middle, suffix) from the ordinal and the text's two cut points and
   filter the units by role;
4. rebuild one list per text and role from the kept units' parents and ``binary_join`` each list into
   its piece;
5. join the pieces with the sentinels in the order of the text's form.

Where the cuts and forms come from (hashes of the id, rates) is Spark's part: ``fim_cuts`` builds them
as column expressions, so that the pipeline only sees texts, two cut points and a form. Rows travel in
slices of at most ``slice_bytes`` bytes of text (a longer text alone), which bounds what a worker holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import pick

# Sentinels of the prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FORMS = ("plain", "psm", "spm")


def _units(texts: pa.Array) -> pa.ListArray:
    """One list of code points per text (null: empty), sharing the texts' data buffer."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    texts = pa.concat_arrays([texts]) if texts.offset else texts
    _, offsets_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offsets_buffer, np.int64)[: len(texts) + 1]
    data = np.frombuffer(data_buffer, np.uint8)[: offsets[-1]] if data_buffer is not None else np.zeros(0, np.uint8)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    unit_offsets = np.append(starts, len(data)).astype(np.int64)
    values = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(unit_offsets), data_buffer if data_buffer is not None else pa.py_buffer(b"")
    )
    list_offsets = np.searchsorted(starts, offsets).astype(np.int64)
    # A sliced batch's texts need not start at byte 0: lists start at their first unit.
    first = int(list_offsets[0])
    return pa.LargeListArray.from_arrays(pa.array(list_offsets - first), values.slice(first))


def _pieces(units: pa.LargeListArray, low: pa.Array, high: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Prefix (ordinal < low), middle (low <= ordinal < high) and suffix of every list, joined."""
    parent = pc.list_parent_indices(units)
    flat = pc.list_flatten(units)
    starts = pa.array(np.asarray(units.offsets)[:-1])
    ordinal = pc.subtract(pa.array(np.arange(len(flat), dtype=np.int64)), pc.take(starts, parent))
    low_at, high_at = pc.take(low, parent), pc.take(high, parent)
    roles = {
        "prefix": pc.less(ordinal, low_at),
        "middle": pc.and_(pc.greater_equal(ordinal, low_at), pc.less(ordinal, high_at)),
        "suffix": pc.greater_equal(ordinal, high_at),
    }
    out = []
    for mask in roles.values():
        kept = pc.filter(flat, mask)
        counts = np.bincount(np.asarray(pc.filter(parent, mask)), minlength=len(units))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        rebuilt = pa.LargeListArray.from_arrays(pa.array(offsets), kept)
        out.append(pc.binary_join(rebuilt, pa.scalar("", pa.large_string())))
    return tuple(out)


def _assemble(texts: pa.Array, form: pa.Array, prefix: pa.Array, middle: pa.Array, suffix: pa.Array) -> pa.Array:
    p, s, m, none = (pa.scalar(v, pa.large_string()) for v in (PREFIX, SUFFIX, MIDDLE, ""))
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    return pc.if_else(pc.equal(form, "psm"), psm, pc.if_else(pc.equal(form, "spm"), spm, texts))


def _slices(batch: pa.RecordBatch, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64)
    start, total = 0, 0
    for k, size in enumerate(sizes):
        if k > start and total + size > slice_bytes:
            yield batch.slice(start, k - start)
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start, len(sizes) - start)


def _transform(slice_bytes: int):
    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, slice_bytes):
                texts = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
                form = batch.column("form")
                plain = pc.equal(form, "plain")
                low = pc.if_else(plain, 0, batch.column("_low")).cast(pa.int64())
                high = pc.if_else(plain, 0, batch.column("_high")).cast(pa.int64())
                prefix, middle, suffix = _pieces(_units(texts), low, high)
                output = _assemble(texts, form, prefix, middle, suffix)
                none = pa.nulls(len(batch), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text"),
                        batch.column("n"),
                        form,
                        pc.if_else(plain, none, low),
                        pc.if_else(plain, none, pc.subtract(high, low)),
                        output.cast(pa.string()),
                    ],
                    names=["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return transform


def _hash_part(digest: Column, k: int) -> Column:
    """The k-th group of 8 hex digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def fim_cuts(doc_id: Column, text: Column, spm_percent: int = 20, plain_percent: int = 10) -> dict[str, Column]:
    """Cut points and form of a text from the sha256 of ``1:`` and its id, as column expressions.

    ``n`` counts code points of the text (null: empty). The prefix ends after the smaller of
    ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units, the middle after the larger. A text is plain if it is
    empty, holds a sentinel, has a null id, or ``h3 % 100 >= 100 - plain_percent``; else SPM if
    ``h4 % 100 < spm_percent``, else PSM.
    """
    body = F.coalesce(text, F.lit(""))
    n = F.length(body).cast("long")
    digest = F.sha2(F.concat(F.lit("1:"), doc_id.cast("string")), 256)
    h = [_hash_part(digest, k) for k in range(4)]
    first, second = F.pmod(h[0], n + 1), F.pmod(h[1], n + 1)
    sentinel = body.contains(PREFIX) | body.contains(SUFFIX) | body.contains(MIDDLE)
    plain = (n == 0) | sentinel | doc_id.isNull() | (F.pmod(h[2], F.lit(100)) >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.pmod(h[3], F.lit(100)) < spm_percent, "spm").otherwise("psm")
    return {"n": n, "low": F.least(first, second), "high": F.greatest(first, second), "form": form}


def fill_in_middle(docs: DataFrame, slice_bytes: int = 4 << 20, spm_percent: int = 20, plain_percent: int = 10) -> DataFrame:
    """(doc_id, text, n, form, prefix_chars, middle_chars, output) for every row of (doc_id, text).

    A null text is the empty text, which stays plain; a null doc_id makes the row plain. Rows are
    transformed one by one, so repeated rows give repeated results; other columns are ignored.
    ``prefix_chars`` and ``middle_chars`` are null for plain rows.
    """
    cuts = fim_cuts(F.col("doc_id"), F.col("text"), spm_percent, plain_percent)
    rows = pick(docs, "doc_id", "text").select(
        "doc_id",
        "text",
        cuts["n"].alias("n"),
        cuts["form"].alias("form"),
        cuts["low"].alias("_low"),
        cuts["high"].alias("_high"),
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, text string, n long, form string, prefix_chars long, middle_chars long, output string"
    )
    return rows.mapInArrow(_transform(slice_bytes), schema)


def restore(output: Column, form: Column) -> Column:
    """The text that an output of the given form came from."""
    parts = F.split(output, "<P>|<S>|<M>", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fim_query(documents: DataFrame) -> DataFrame:
    """op12: every document with its form, cut sizes and the digests of output and restored text."""
    done = fill_in_middle(documents)
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('1:' || CAST(doc_id AS VARCHAR)) AS dg
  FROM documents
), c AS (
  SELECT doc_id, body, length(body) AS n,
         CAST(('0x' || substr(dg, 1, 8)) AS UBIGINT) AS h1, CAST(('0x' || substr(dg, 9, 8)) AS UBIGINT) AS h2,
         CAST(('0x' || substr(dg, 17, 8)) AS UBIGINT) AS h3, CAST(('0x' || substr(dg, 25, 8)) AS UBIGINT) AS h4
  FROM d
), f AS (
  SELECT doc_id, body, n,
         CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS lo,
         CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS hi,
         CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                   OR doc_id IS NULL OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM c
), p AS (
  SELECT doc_id, body, n, form, lo, hi,
         substring(body, 1, lo) AS pre, substring(body, lo + 1, hi - lo) AS mid, substring(body, hi + 1) AS suf
  FROM f
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form = 'plain' THEN NULL ELSE CAST(lo AS BIGINT) END AS prefix_chars,
       CASE WHEN form = 'plain' THEN NULL ELSE CAST(hi - lo AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                        ELSE body END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM p
"""
