"""Token counts through a cache of digests.

A text counts once per tokenizer: the digests of the normalised texts and of the tokenizer file are joined
with the counts stored so far, only distinct misses are encoded, and their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import fresh_name
from keepwell.scratch import materialise

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"
COUNT_ROWS = 128


@lru_cache(maxsize=2)
def counter(path: str) -> Callable[[Sequence[str]], list[int]]:
    """Token counts of texts by the library that the file belongs to, without begin and end tokens."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(list(texts), num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda texts: [len(x.ids) for x in tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file, which the driver reads too."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def normalised(text: Column) -> Column:
    """What the digest is taken of. Both libraries' files keep all characters, so only NULL is changed."""
    return F.coalesce(text, F.lit(""))


def _stored(docs: DataFrame, cache: str, version: str) -> DataFrame:
    """Counts of this tokenizer version, one per digest; none if the cache is not there yet."""
    spark = docs.sparkSession
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    of_version = stored.filter(F.col("tokenizer") == version)
    return of_version.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """Per row: the identifier, n_bytes, n_tokens and over_limit (n_tokens above ``limit``).

    ``tokenizer`` is a file that every executor can read, ``cache`` a folder that all share. NULL counts
    as the empty text. NULL and repeated identifiers and repeated rows have a result each; copies of a text are encoded once
    and moved once per task that reads them. Texts are encoded whole. Other columns are not read. An
    empty table gives an empty result. A run that is cut short may append a digest twice; both
    rows then have the same count, and one is taken.
    """
    version = tokenizer_version(tokenizer)
    text = normalised(F.col(text_col))
    digest = F.unhex(F.sha2(text, 256))
    rows = materialise(
        docs.select(
            F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), digest.alias("digest")
        ),
        "digests",
    )
    distinct = docs.select(digest.alias("digest"), text.alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(_stored(docs, cache, version), "digest", "left_anti")

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(tokenizer)
        for frame in frames:
            texts = frame["text"].tolist()
            counts = [n for at in range(0, len(texts), COUNT_ROWS) for n in count(texts[at : at + COUNT_ROWS])]
            yield pd.DataFrame({"digest": frame["digest"], "tokenizer": version, "n_tokens": counts})

    misses.mapInPandas(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    counts = materialise(_stored(docs, cache, version), "counts")  # so that a hot digest can be split in the join
    names = [fresh_name([id_col], n) for n in ("n_bytes", "n_tokens", "over_limit")]
    return rows.join(counts, "digest").select(
        F.col("id").alias(id_col),
        F.col("n_bytes").alias(names[0]),
        F.col("n_tokens").alias(names[1]),
        (F.col("n_tokens") > limit).alias(names[2]),
    )
