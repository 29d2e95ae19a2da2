"""Byte-level BPE by the tiktoken library and a local rank file: texts to ids and ids to raw bytes.

The pattern cuts a text into matches and each is merged on its own.  A long
text is first cut where every way through the pattern ends a match, so the
library sees bounded parts; a run of white space too long for its regex engine
is merged as the single match it is.

Scale: a map over Arrow batches without a shuffle.  The ranks are read where
the job is planned and broadcast, which ``MOST_RANK_BYTES`` bounds; each Python
worker builds one encoder of them.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytesnp import by_size
from .common import bytes_of, query, table

MOST_RANK_BYTES = 64 << 20
PART = 1 << 16  # code points; longer texts are cut
LONG_RUN = 100_000  # white space; the library's engine gives up at a million
BATCH_BYTES = 4 << 20
# The characters of the Unicode property White_Space, as a class (fixed values).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A match never goes on from a visible character to white space, nor, as there is
# no alternative for it, from letters to anything else or from digits to anything else.
CUT = re.compile(f"[^{SPACE}](?=[{SPACE}])")
CUT_ANY = regex.compile(rf"\p{{L}}(?=\P{{L}})|\p{{N}}(?=\P{{N}})|[^{SPACE}](?=[{SPACE}])")
RUN = re.compile(f"[{SPACE}]{{{LONG_RUN},}}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by token from a rank file: a line holds a token in base64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def safe_parts(text: str, size: int = PART) -> Iterator[str]:
    """Parts of about ``size`` code points whose matches, in a row, are the text's.

    A cut before white space is looked for in as much text again; where there
    is none, the next change of character class is taken.
    A stretch without either is one match and stays whole.
    """
    at = 0
    while len(text) - at > size:
        cut = CUT.search(text, at + size - 1, at + 2 * size) or CUT_ANY.search(text, at + size - 1)
        if cut is None:
            break
        yield text[at:cut.end()]
        at = cut.end()
    yield text[at:]


class ByteBpe:
    """Ids of texts and bytes of ids, for ranks and a pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= PART:
            return self.encoding.encode_to_numpy(text)
        return np.concatenate([np.empty(0, np.uint32), *(ids for part in safe_parts(text) for ids in self._part(part))])

    def _part(self, text: str) -> Iterator[np.ndarray]:
        at = 0
        if len(text) >= LONG_RUN:
            for run in RUN.finditer(text):
                # before a visible character the last blank is left to what follows
                end = run.end() - (run.end() < len(text))
                yield self.encoding.encode_to_numpy(text[at:run.start()])
                yield np.array(self.encoding._core_bpe.encode_single_piece(text[run.start():end].encode()), np.uint32)
                at = end
        yield self.encoding.encode_to_numpy(text[at:])

    def decode(self, ids: np.ndarray) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())


_LOADED: dict[str, ByteBpe] = {}


class Shared:
    """Broadcast ranks with their pattern; ``get`` gives a worker's encoder."""

    def __init__(self, spark: SparkSession, path: str | None, pattern: str | None):
        path = path or default_path()
        if os.path.getsize(path) > MOST_RANK_BYTES:
            raise ValueError(f"rank file over {MOST_RANK_BYTES} bytes: {path}")
        with open(path, "rb") as f:
            data = f.read()
        self.pattern = pattern or default_pattern()
        self.token = hashlib.sha256(data + self.pattern.encode()).hexdigest()
        self.data = spark.sparkContext.broadcast(data)

    def get(self) -> ByteBpe:
        if self.token not in _LOADED:
            _LOADED.clear()
            _LOADED[self.token] = ByteBpe(parse_ranks(self.data.value), self.pattern)
        return _LOADED[self.token]


def encode(docs: DataFrame, text: str = "text", key: str = "doc_id", ranks: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """Ids of every text: ``key``, ``n_tokens``, ``ids`` (array of int).

    Special tokens' strings in a text are plain text.  A null or empty text has
    no ids.  Null and repeated keys are kept, one row for each input row, and
    an empty table gives an empty result.  Other columns play no part.
    ``ranks`` is a file that the driver can read.
    """
    shared = Shared(docs.sparkSession, ranks, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.get()
        for batch in by_size(batches, "body", BATCH_BYTES):
            found = [bpe.encode(body.as_py().decode("utf-8", "replace")) for body in batch["body"]]
            sizes = np.array([len(x) for x in found], np.int64)
            flat = np.concatenate([np.empty(0, np.uint32), *found]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sizes), lists], names=["id", "n_tokens", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), bytes_of(text).alias("body")) \
        .mapInArrow(run, f"id {kind}, n_tokens long, ids array<int>").withColumnRenamed("id", key)


def decode(encoded: DataFrame, ids: str = "ids", name: str = "decoded", ranks: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """Add the raw bytes (column ``name``) that ``ids`` stand for; ``ids`` goes, other columns stay.

    The bytes of cut-off ids need not be valid UTF-8, so they are not turned
    into text.  Null ids give null; an id outside the ranks is an error.
    """
    shared = Shared(encoded.sparkSession, ranks, pattern)
    kept = [c for c in encoded.columns if c != ids]
    rows = encoded.select(F.struct(*kept).alias("row"), F.col(ids).alias("ids"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.get()
        for batch in batches:
            back = [None if x is None else bpe.decode(x) for x in
                    (None if not x.is_valid else x.values.to_numpy(zero_copy_only=False) for x in batch["ids"])]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(back, pa.binary())], names=["row", "decoded"])

    return rows.mapInArrow(run, schema).select("row.*", F.col("decoded").alias(name))


@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    got = decode(got.withColumn("ids_sha256", F.sha2(decimal.cast("binary"), 256)))
    return got.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
