"""Quality by perplexity: an interpolated modified Kneser-Ney model of character 4-grams.

The model counts the trusted documents; every document is scored by it and kept if
its perplexity lies between quantiles of its language's trusted documents. A 4-gram is
one long of four 16-bit code units, so contexts and suffixes are shifts and masks.

Counts and scores meet in sharded joins. Documents are dealt into chunks of about
``DOCUMENTS_PER_CHUNK`` by a hash of their id, with zstd-compressed texts. Each chunk
gives its distinct 4-grams with their counts in trusted documents; counts, context
totals and probabilities are grouped and joined by 4-gram; each chunk gets back the
scores of its own 4-grams, to sum them up per document. Nothing is broadcast or
collected but the twelve discounts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches
from millrace.session import reliable_checkpoint, scratch_path

ORDER = 4
# Rows of a table of grams in one partition: small tables do not go through many.
GRAMS_PER_PARTITION = 250_000
DOCUMENTS_PER_CHUNK = 4_000
LOWEST, HIGHEST = 0.002, 0.99
# How far beyond the quantiles a document may lie, as a factor of its perplexity.
SLACK = 1.1
_START = "\x02" * (ORDER - 1)
_SLICE = 1_500_000


def grams_of(texts: list[str]) -> np.ndarray:
    """The 4-gram that ends at each letter of each text, in order; start marks stand before a text."""
    joined = "".join([_START + t for t in texts])
    units = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # Letters beyond 16 bits share the private area; they are rare and only ever count as such.
    units = np.where(units > 0xFFFF, 0xE000 + units % 6400, units).astype(np.uint64)
    shift = np.uint64(16)
    grams = (((units[:-3] << shift | units[1:-2]) << shift | units[2:-1]) << shift) | units[3:]
    real = np.ones(len(units), dtype=bool)
    starts = np.cumsum([0, *[len(t) + len(_START) for t in texts[:-1]]])
    for i in range(len(_START)):
        real[starts + i] = False
    return grams[real[3:]].view(np.int64)


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """The texts in runs of about _SLICE letters, each with the number of its first text."""
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        run.append(text)
        size += len(text)
        if size >= _SLICE:
            yield first, run
            first, run, size = i + 1, [], 0
    if run:
        yield first, run


def _texts(table: pa.Table) -> list[str]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(z).decode() if z else "" for z in table.column("packed").to_pylist()]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(place, np.concatenate([n for _, n in parts]), len(grams)).astype(np.int64)


def _count_chunk(key: tuple, docs: pa.Table, trusted: pa.Table) -> pa.Table:
    """A chunk's distinct 4-grams with their counts in its trusted documents."""
    good = set(trusted.column("doc").to_pylist())
    ids, texts = docs.column("doc").to_pylist(), _texts(docs)
    parts = []
    for wanted in (True, False):
        for _, run in _slices([t for d, t in zip(ids, texts) if t and (d in good) == wanted]):
            grams, counts = np.unique(grams_of(run), return_counts=True)
            parts.append((grams, counts if wanted else np.zeros_like(counts)))
            if len(parts) >= 8:
                parts = [_merged(parts)]
    grams, counts = _merged(parts)
    return pa.table({"chunk": pa.array(np.full(len(grams), key[0].as_py(), np.int64)), "gram": grams, "n": counts})


def _score_chunk(key: tuple, docs: pa.Table, scores: pa.Table) -> pa.Table:
    """Letters and summed log probability of each document of a chunk."""
    grams = scores.column("gram").to_numpy()
    order = np.argsort(grams)
    grams, logs = grams[order], scores.column("log_p").to_numpy()[order]
    texts = _texts(docs)
    letters = np.array([len(t) for t in texts], dtype=np.int64)
    sums = np.zeros(len(texts))
    for first, run in _slices(texts):
        own = letters[first : first + len(run)]
        full = np.flatnonzero(own)
        if len(full):
            found = logs[np.searchsorted(grams, grams_of(run))].astype(np.float64)
            sums[first + full] = np.add.reduceat(found, np.concatenate([[0], np.cumsum(own[full])[:-1]]))
    return pa.table({"doc": docs.column("doc"), "lang": docs.column("lang"), "letters": letters, "log_p": sums})


def _packed(df: DataFrame, chunks: int, key: str, text: str, lang: str) -> DataFrame:
    """(chunk, doc, lang, packed): the texts compressed before they are dealt out."""
    chunk = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("long"), F.xxhash64(text))), F.lit(chunks))

    def pack(batches: Iterator) -> Iterator[dict]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [tool.compress(t.encode()) if (t := v.as_py()) else None for v in batch.column(3)]
            yield {"chunk": batch.column(0), "doc": batch.column(1), "lang": batch.column(2), "packed": packed}

    rows = df.select(chunk.alias("chunk"), F.col(key).cast("long"), F.col(lang).cast("string"), F.col(text))
    return map_batches(rows, pack, "chunk long, doc long, lang string, packed binary")


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """The modified discounts for counts of 1, 2 and more, from how many 4-grams come 1, 2, 3, 4 times."""
    n1, n2, n3, n4 = counts
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(found))


def _suffix(gram: Column, order: int) -> Column:
    return gram if order == ORDER else gram.bitwiseAND(F.lit((1 << (16 * order)) - 1))


def _context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, 16)


def _compact(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than its number of rows calls for."""
    return df.coalesce(max(1, -(-rows // GRAMS_PER_PARTITION)))


def _log_probabilities(grams: DataFrame) -> DataFrame:
    """(gram, log_p) for every row of ``grams(gram, n)``; n is the count in trusted text.

    Lower orders count in how many different longer grams they end. Order 1 has one context,
    the empty one: its total is one number.
    """
    size = grams.count()
    scored = _compact(grams, size).select("gram", F.lit(None).cast("double").alias("p"))
    counted, often = {ORDER: grams.filter("n > 0").select("gram", F.col("n").alias("c"))}, {}
    counts = [F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(1, 5)]
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            longer = counted[order + 1].select(_suffix(F.col("gram"), order).alias("gram"))
            counted[order] = reliable_checkpoint(longer.groupBy("gram").agg(F.count(F.lit(1)).alias("c")))
        often[order] = counted[order].agg(*counts, F.count(F.lit(1)).alias("all")).first()
        counted[order] = _compact(counted[order], often[order]["all"])
    lower = None
    for order in range(1, ORDER + 1):
        rows, of = counted[order], often[order]
        d1, d2, d3 = discounts(list(of)[:4])
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(F.lit(d3))
        rows = rows.select("gram", "c", F.least(cut, F.col("c").cast("double")).alias("cut"))
        uniform = 1.0 / (of["all"] + 1)
        shares = [F.sum("c").alias("total"), (F.sum("cut") / F.sum("c")).alias("rest")]
        if order == 1:
            whole = rows.agg(*shares).first()
            rest = F.lit(1.0 if whole["rest"] is None else whole["rest"])
            own = (F.col("c") - F.col("cut")) / F.lit(whole["total"])
            lower = reliable_checkpoint(rows.select("gram", (own + rest * uniform).alias("p")))
            known = scored.withColumn("s", _suffix(F.col("gram"), 1)).join(_named(lower), "s", "left")
            scored = _compact(known.select("gram", F.coalesce("known", rest * uniform).alias("p")), size)
            continue
        rows = rows.withColumn("h", _context(F.col("gram")))
        totals = reliable_checkpoint(_compact(rows.groupBy("h").agg(*shares), of["all"]))
        seen = _compact(rows.join(totals, "h"), of["all"]).select(
            "gram", ((F.col("c") - F.col("cut")) / F.col("total")).alias("own"), "rest"
        )
        below = lower.withColumnRenamed("gram", "s").withColumnRenamed("p", "below")
        seen = seen.withColumn("s", _suffix(F.col("gram"), order - 1)).join(below, "s").select(
            "gram", (F.col("own") + F.col("rest") * F.col("below")).alias("p")
        )
        lower = reliable_checkpoint(_compact(seen, of["all"]))
        suffix = _suffix(F.col("gram"), order)
        keyed = scored.select("gram", "p", suffix.alias("s"), _context(suffix).alias("h"))
        joined = _compact(keyed.join(_named(lower), "s", "left"), size).join(totals.select("h", "rest"), "h", "left")
        unseen = F.coalesce("rest", F.lit(1.0)) * F.coalesce("p", F.lit(uniform))
        scored = _compact(joined.select("gram", F.coalesce("known", unseen).alias("p")), size)
    return scored.select("gram", F.log("p").cast("float").alias("log_p"))


def _named(lower: DataFrame) -> DataFrame:
    return lower.select(F.col("gram").alias("s"), F.col("p").alias("known"))


def perplexities(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc, lang, letters, log_p, trusted) of every row of ``df``; log_p is summed over the letters.

    Trusted are the documents that ``labels(doc_id, quality)`` calls 1 and never else.
    """
    spark = df.sparkSession
    chunks = max(1, -(-df.count() // DOCUMENTS_PER_CHUNK))
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
    good = good.filter("least = 1 AND most = 1").select(F.col("doc_id").cast("long").alias("doc"))
    by_chunk = good.select(F.pmod(F.xxhash64("doc"), F.lit(chunks)).alias("chunk"), "doc")
    packed = _packed(df, chunks, key, text, lang)
    table = scratch_path(spark, "grams")
    counted = packed.groupBy("chunk").cogroup(by_chunk.groupBy("chunk")).applyInArrow(
        _count_chunk, "chunk long, gram long, n long"
    )
    counted.write.parquet(table)
    counted = spark.read.parquet(table)
    grams = reliable_checkpoint(counted.groupBy("gram").agg(F.sum("n").alias("n")))
    scores = counted.select("chunk", "gram").join(_log_probabilities(grams), "gram").select("chunk", "gram", "log_p")
    summed = packed.groupBy("chunk").cogroup(scores.groupBy("chunk")).applyInArrow(
        _score_chunk, "doc long, lang string, letters long, log_p double"
    )
    return summed.join(good.select("doc", F.lit(True).alias("trusted")), "doc", "left").select(
        "doc", "lang", "letters", "log_p", F.coalesce("trusted", F.lit(False)).alias("trusted")
    )


def classify(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    lowest: float = LOWEST, highest: float = HIGHEST, slack: float = SLACK,
) -> DataFrame:
    """One row per row of ``df``: key, lang, ``perplexity``, its limits ``least`` and ``most``, ``kept``.

    The limits are quantiles of the language's trusted documents, widened by ``slack``.
    A language without trusted documents takes those of all languages; without any, or
    with no labels, everything that has a text is kept. NULL and empty texts have no
    perplexity and are not kept. A NULL language is one of its own. Rows with the same
    key are judged each for itself.
    """
    scored = reliable_checkpoint(
        perplexities(df, labels, key, text, lang).select(
            "doc", "lang", "trusted", F.when(F.col("letters") > 0, F.exp(-F.col("log_p") / F.col("letters"))).alias("perplexity"),
        )
    )
    limits = F.percentile_approx("perplexity", [lowest, highest], 100_000).alias("q")
    trusted = scored.filter("trusted AND perplexity IS NOT NULL")
    per_lang = trusted.groupBy("lang").agg(limits).select(F.col("lang").alias("of"), F.col("q").alias("own"))
    overall = trusted.agg(limits).first()["q"] or [None, None]
    joined = scored.join(per_lang, F.col("lang").eqNullSafe(F.col("of")), "left")
    least, most = [
        F.coalesce(F.col("own")[i], F.lit(overall[i]).cast("double")) * f for i, f in ((0, 1 / slack), (1, slack))
    ]
    limited = joined.select("doc", "lang", "perplexity", least.alias("least"), most.alias("most"))
    inside = F.coalesce(F.col("perplexity").between(F.col("least"), F.col("most")), F.lit(True))
    return limited.select(
        F.col("doc").alias(key), F.col("lang").alias(lang), "perplexity", "least", "most",
        (F.col("perplexity").isNotNull() & inside).alias("kept"),
    )
