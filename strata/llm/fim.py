"""Fill-in-middle: documents rearranged so that a model learns to write the missing middle.

A text is a sequence of code points.  A hash of its key places two cuts, which
part it into prefix, middle and suffix, and chooses the form: plain (as it is),
psm (prefix, suffix, middle) or spm (suffix, prefix, middle), each piece after
its mark.

Scale: a map over Arrow batches; nothing is shuffled and nothing depends on
other rows.  The pieces are cut by Arrow kernels over the units of all texts of
a batch at once.  A text longer than ``PART`` units goes through in parts, so
memory beside the text itself is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .bytesnp import buffer_of, by_size
from .common import query, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FIM_PERCENT, SPM_PERCENT = 90, 20
PART = 1 << 18  # units handled at once
BATCH_BYTES = 1 << 20


def units_of(texts: pa.Array) -> pa.ListArray:
    """Each text as the list of its code points (``texts``: strings without nulls or an offset)."""
    raw, offsets = buffer_of(texts)
    lead = pc.not_equal(pc.bit_wise_and(pa.array(raw), pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8()))
    starts = pc.cast(pc.indices_nonzero(lead), pa.int32())
    ends = pa.concat_arrays([starts, pa.array([len(raw)], pa.int32())])
    units = pa.StringArray.from_buffers(len(starts), ends.buffers()[1], pa.py_buffer(raw))
    sizes = pc.utf8_length(texts)
    return pa.ListArray.from_arrays(_offsets(sizes), units)


def _offsets(sizes: pa.Array) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))]).astype(np.int32))


def pieces(texts: pa.Array, base: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each part of a text.

    ``base``: the units of its text before the part; ``first`` and ``second``:
    where the text's prefix and middle end.
    """
    lists = units_of(texts)
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    begin = pa.array(base - lists.offsets.to_numpy()[:-1])
    ordinal = pc.add(pa.array(np.arange(len(units))), pc.take(begin, parent))
    role = pc.add(pc.cast(pc.greater_equal(ordinal, pc.take(pa.array(first), parent)), pa.int8()),
                  pc.cast(pc.greater_equal(ordinal, pc.take(pa.array(second), parent)), pa.int8()))
    out = []
    for r in range(3):
        mine = pc.equal(role, pa.scalar(r, pa.int8()))
        held = np.bincount(pc.filter(parent, mine).to_numpy(), minlength=len(texts))
        lists = pa.ListArray.from_arrays(_offsets(pa.array(held)), pc.filter(units, mine))
        out.append(pc.binary_join(lists, ""))
    return out


def _cut(texts: pa.Array, sizes: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, long ones in parts."""
    if not len(texts) or sizes.max() <= PART:
        return pieces(texts, np.zeros(len(texts), np.int64), first, second)
    found: list[list[pa.Array]] = [[], [], []]
    counts = []
    for i, n in enumerate(sizes.tolist()):
        text = texts[i].as_py()
        starts = range(0, max(n, 1), PART)
        counts.append(len(starts))
        for at in starts:
            got = pieces(pa.array([text[at:at + PART]]), np.array([at]), first[i:i + 1], second[i:i + 1])
            for f, g in zip(found, got):
                f.append(g)
    whole = _offsets(pa.array(counts))
    return [pc.binary_join(pa.ListArray.from_arrays(whole, pa.concat_arrays(f)), "") for f in found]


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, "body", BATCH_BYTES):
        form, body = batch["form"], pa.concat_arrays([batch["body"]])
        sizes, first, second = (batch[c].to_numpy(zero_copy_only=False) for c in ("n", "first", "second"))
        moved = pc.not_equal(form, PLAIN)
        at = pc.indices_nonzero(moved).to_numpy()
        prefix, middle, suffix = _cut(pc.filter(body, moved), sizes[at], first[at], second[at])
        psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
        spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
        made = pc.if_else(pc.equal(pc.filter(form, moved), PSM), psm, spm)
        output = pc.replace_with_mask(body, moved, made)
        yield pa.RecordBatch.from_arrays([batch["id"], batch["n"], form, batch["prefix_chars"], batch["middle_chars"], output],
                                         names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])
        pa.default_memory_pool().release_unused()


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 1,
                   percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Rearrange each text by cuts that depend on ``seed`` and its key alone.

    Returns one row per input row: ``key``, ``n`` (code points), ``form``,
    ``prefix_chars``, ``middle_chars`` (code points; null if plain) and
    ``output``.

    A text is plain if it is empty, if it holds one of the marks, or by the
    hash in all but ``percent`` percent of the cases; of the others
    ``spm_percent`` percent are spm.  A null text is the empty one.  A null key
    is hashed as the empty string, and rows that repeat a key are cut at the
    same shares of their hashes.  Prefix, middle and suffix may each be empty.
    An empty table gives an empty result.  Other columns play no part.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(key).alias("id"), body.alias("body"), F.length(body).cast("long").alias("n"), digest.alias("digest"))
    rows = rows.select("id", "body", "n", *[
        F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)])
    plain = (F.col("n") == 0) | (F.col("h3") % 100 >= percent)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(F.col("body"), F.lit(mark))
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    rows = rows.select("id", "body", "n", F.least(one, two).alias("first"), F.greatest(one, two).alias("second"),
                       F.when(plain, PLAIN).when(F.col("h4") % 100 < spm_percent, SPM).otherwise(PSM).alias("form"))
    rows = rows.select("*", F.when(F.col("form") != PLAIN, F.col("first")).alias("prefix_chars"),
                       F.when(F.col("form") != PLAIN, F.col("second") - F.col("first")).alias("middle_chars"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_transform, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string") \
        .withColumnRenamed("id", key)


def _restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts that outputs were made of: a mark occurs once, at its place."""
    out = output
    for kind, begin, between in ((PSM, PREFIX, SUFFIX), (SPM, SUFFIX, PREFIX)):
        mine = pc.fill_null(pc.equal(form, kind), False)
        ends = pc.split_pattern(pc.filter(output, mine), MIDDLE, max_splits=1)
        head, middle = pc.list_element(ends, 0), pc.list_element(ends, 1)
        both = pc.split_pattern(head, between, max_splits=1)
        one, two = pc.utf8_slice_codeunits(pc.list_element(both, 0), len(begin)), pc.list_element(both, 1)
        prefix, suffix = (one, two) if kind == PSM else (two, one)
        out = pc.replace_with_mask(out, mine, pc.binary_join_element_wise(prefix, middle, suffix, ""))
    return out


def restore(made: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """Add the exact text (column ``name``) rebuilt from ``output`` and ``form``; ``output`` goes.

    A null output gives null, an unknown or null form is taken as plain, an
    output without the marks of its form is an error, and other columns stay.
    """
    kept = [c for c in made.columns if c != output]
    rows = made.select(F.struct(*kept).alias("row"), F.when(F.col(output).isNotNull(), F.col(form)).alias("form"),
                       F.coalesce(F.col(output), F.lit("")).alias("body"), F.col(output).isNull().alias("none"))
    schema = rows.select("row", F.when(~F.col("none"), F.col("body")).alias("restored")).schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "body", BATCH_BYTES):
            back = _restored(batch["body"], batch["form"])
            back = pc.if_else(batch["none"], pa.scalar(None, pa.string()), back)
            yield pa.RecordBatch.from_arrays([batch["row"].cast(arrow.field("row").type), back], names=["row", "restored"])
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema).select("row.*", F.col("restored").alias(name))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
h AS (SELECT doc_id, t, n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
  CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4 FROM d),
f AS (SELECT doc_id, t, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
    WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""


@query("op11_fill_in_middle", SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    made = made.withColumn("output_sha256", F.sha2(F.col("output").cast("binary"), 256))
    return restore(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                                F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))
