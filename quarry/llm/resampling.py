"""Importance resampling of documents towards a target distribution.

Texts are bags of hashed word n-grams.  Each bucket's gain is the log ratio
of its smoothed share in the target texts and in the corpus; a document's
weight is the sum of the gains of its features, looked up in one array of
``buckets`` integers.  A Gumbel draw per document turns "sample without
replacement in proportion to exp(weight)" into "take the k highest scores":

1. count buckets over all documents and over the target (partial counts per
   task, at most ``buckets`` rows a task in the shuffle);
2. score every document by array lookups; write the keys;
3. distributed quickselect: random pivot keys are drawn from the range still
   open, every key is counted as below, equal to or above each pivot, and the
   range shrinks to the gap that holds the k-th key, until a pivot is it;
4. only the winners are range-partitioned, sorted and ranked.

The composite key is (score descending, id ascending, null ids last, number
of features, row number), so it is unique and ties need no rule of their own.

Defined cases: null and empty texts have no features and weight 0; a null id
is drawn with the hash of ``42:``; repeated rows compete separately and those
of one key take neighbouring ranks; an empty target gives all-smoothed gains;
an empty table gives no rows; fewer than 1/share eligible documents draw none;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from hashlib import sha256
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_texts, release, slices, stash

BUCKETS = 10_000
ORDER = 3                   # longest run of words that is a feature
SHARE = (5, 100)            # of the eligible documents, rounded down
MIN_WORDS = 20              # words an eligible document has at least
SEED = 42
PIVOTS = 16                 # random pivot keys of one quickselect round

_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else
                    b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words: runs of ASCII letters, digits and all non-ASCII."""
    return text.translate(_WORD_BYTES).split()


def feature_buckets(words: list[bytes], order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every run of 1..order words; a run's crc32 continues the
    crc32 of the run one word shorter."""
    spaced = [b" " + w for w in words]
    crcs = list(map(crc32, words))
    found = crcs
    for n in range(1, min(order, len(words))):
        crcs = list(map(crc32, spaced[n:], crcs))
        found = found + crcs
    return np.asarray(found, dtype=np.int64) % buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", order: int = ORDER,
                  buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of each bucket over all rows (an array of ``buckets``)."""
    def run(batches):
        import pyarrow as pa
        total = np.zeros(buckets, dtype=np.int64)
        for batch in (x for whole in batches for x in slices(whole)):
            for text in byte_texts(batch.column(0)):
                total += np.bincount(feature_buckets(words_of(text), order, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])
        release()

    parts = texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():      # at most `buckets` rows
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) per bucket, in doubles."""
    n = len(corpus)
    s_all, t_all = float(corpus.sum()) + n, float(target.sum()) + n
    return np.asarray([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                       for t, s in zip(target, corpus)], dtype=np.int64)


def draw(doc_id, seed: int = SEED) -> int:
    """floor(1000 x Gumbel) of an id's hash."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
           order: int = ORDER, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, row) of every document."""
    buckets = len(gains)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        for batch in (x for whole in batches for x in slices(whole)):
            ids = batch.column(0).to_pylist()
            n_words, n_features, weight = [], [], []
            for text in byte_texts(batch.column(1)):
                words = words_of(text)
                found = feature_buckets(words, order, buckets)
                n_words.append(len(words))
                n_features.append(len(found))
                weight.append(int(gains[found].sum()))
            score = [w + draw(i, seed) for w, i in zip(weight, ids)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight, score)),
                 pa.array(range(row, row + len(ids)), pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight", "score", "row"])
            row += len(ids)
        release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint, row bigint")


# ---- distributed quickselect ------------------------------------------------

def _literal(key) -> Column:
    return F.struct(*(F.lit(v).cast("long").alias(f"k{i}") for i, v in enumerate(key)))


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS, seed: int = SEED) -> tuple | None:
    """The k-th smallest (from 1) of the unique keys in column ``key``, a
    struct of longs; None when there are fewer.

    Each round sends ``pivots`` keys and as many counts to the driver,
    whatever the size of the table, and cuts the open range to about one part
    in ``pivots``; the keys themselves are never moved.
    """
    if k < 1:
        return None
    key = F.col("key")
    low = high = None                       # open range; `below` keys lie at or under low
    below, round_ = 0, 0
    while True:
        inside = keys
        if low is not None:
            inside = inside.where(key > _literal(low))
        if high is not None:
            inside = inside.where(key < _literal(high))
        drawn = sorted(tuple(r["key"]) for r in inside.orderBy(F.xxhash64(key, F.lit(seed + round_)), key)
                       .select("key").limit(pivots).collect())
        if not drawn:
            return None
        counts = inside.agg(*(F.count_if(key < _literal(p)).alias(f"below{i}") for i, p in enumerate(drawn)),
                            *(F.count_if(key == _literal(p)).alias(f"equal{i}") for i, p in enumerate(drawn))).first()
        lower, passed = low, below
        for i, p in enumerate(drawn):
            first = below + counts[f"below{i}"] + 1
            if first <= k < first + counts[f"equal{i}"]:
                return p
            if first > k:
                high = p
                break
            lower, passed = p, first + counts[f"equal{i}"] - 1
        low, below, round_ = lower, passed, round_ + 1


def ranked(winners: DataFrame) -> DataFrame:
    """Winners with ``rank`` 1, 2, 3... in key order: range partitions, a
    counter inside each, and the sizes of the partitions before it."""
    parts = stash(winners.repartitionByRange(F.col("key")).withColumn("part", F.spark_partition_id()), "winners")
    before, offsets = 0, []
    for r in parts.groupBy("part").count().orderBy("part").collect():             # one row per partition
        offsets.append((r["part"], before))
        before += r["count"]
    if not offsets:
        return winners.withColumn("rank", F.lit(None).cast("long"))
    offset = F.create_map(*(F.lit(x) for pair in offsets for x in pair))[F.col("part")]
    place = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    return parts.withColumn("rank", place.cast("long") + offset).drop("part")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS,
             order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every document with (doc_id, n_features, weight, score, rank); ``rank``
    is null for documents that were not drawn."""
    gains = bucket_gains(bucket_counts(target, target_col, order, buckets),
                         bucket_counts(docs, text_col, order, buckets))
    rows = stash(scored(docs, gains, id_col, text_col, order, seed), "scores")
    key = F.struct((-F.col("score")).alias("k0"), F.col("doc_id").isNull().cast("long").alias("k1"),
                   F.coalesce("doc_id", F.lit(0)).alias("k2"), F.col("n_features").alias("k3"), F.col("row").alias("k4"))
    keyed = rows.withColumn("key", key)
    eligible = keyed.where(F.col("n_words") >= min_words)
    k = share[0] * eligible.count() // share[1]
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    none = F.lit(None).cast("long")
    last = kth_key(eligible.select("key"), k)
    if last is None:
        return rows.withColumn("rank", none).select(*out)
    won = (F.col("n_words") >= min_words) & (F.col("key") <= _literal(last))
    return (ranked(keyed.where(won).select("key", "doc_id", "n_features", "weight", "score")).select(*out)
            .unionByName(keyed.where(~won).withColumn("rank", none).select(*out)))


def oracle_sql() -> str:
    """crc32 is linear over the bits: a text's is the exclusive or of one term
    per byte (by value and distance from the end) and one per length."""
    words = """
      SELECT {row}, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM {table}"""
    grams = """
      SELECT r, w[i] AS f FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM {t})
      UNION ALL SELECT r, w[i] || ' ' || w[i + 1] FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM {t})
      UNION ALL SELECT r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM {t})"""
    return f"""
    WITH RECURSIVE dw AS MATERIALIZED ({words.format(row="row_number() OVER () AS r, doc_id", table="documents")}),
    bw AS ({words.format(row="0 AS r", table="benchmark")}),
    df AS ({grams.format(t="dw")}), bf AS ({grams.format(t="bw")}),
    feats AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)),
    -- c: the term of a byte with only bit j set, d bytes before the end
    steps AS (SELECT 0 AS s, j, (1::BIGINT << j) AS c FROM range(8) t(j)
              UNION ALL
              SELECT s + 1, j, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
              FROM steps WHERE s < 8 * (SELECT max(strlen(f)) + 5 FROM feats)),
    bits AS (SELECT s // 8 - 1 AS d, j, c FROM steps WHERE s % 8 = 0 AND s > 0),
    byte_terms AS (SELECT d, b, bit_xor(c) AS c FROM bits, range(256) t(b) WHERE (b >> j) & 1 = 1 GROUP BY d, b),
    -- the start value FFFFFFFF acts on the first four bytes
    heads AS (SELECT d, c FROM byte_terms WHERE b = 255),
    chars AS (SELECT f, strlen(f) - 1 - i AS d, ('0x' || substr(h, 2 * i + 1, 2))::INT AS b, i
              FROM (SELECT f, h, unnest(range(strlen(f))) AS i FROM feats)),
    terms AS (SELECT f, c.d, t.c FROM chars c JOIN byte_terms t ON t.d = c.d AND t.b = c.b
              UNION ALL SELECT f, h.d, h.c FROM (SELECT f, strlen(f) - 1 - i AS d
                   FROM (SELECT f, unnest(range(least(strlen(f), 4))) AS i FROM feats)) c JOIN heads h ON h.d = c.d),
    crcs AS (SELECT f, xor(bit_xor(c), 4294967295) AS crc FROM terms GROUP BY f),
    fixed AS (SELECT f, CASE strlen(f) WHEN 1 THEN xor(crc, 16777215) WHEN 2 THEN xor(crc, 65535)
                        WHEN 3 THEN xor(crc, 255) ELSE crc END % {BUCKETS} AS k FROM crcs),
    sd AS (SELECT k, count(*) AS n FROM df JOIN fixed USING (f) GROUP BY k),
    sb AS (SELECT k, count(*) AS n FROM bf JOIN fixed USING (f) GROUP BY k),
    gains AS (SELECT b AS k, floor(1000 * ln((coalesce(sb.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM sd) + {BUCKETS})::DOUBLE
                / ((coalesce(sd.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM sb) + {BUCKETS})::DOUBLE)))::BIGINT AS g
              FROM range({BUCKETS}) t(b) LEFT JOIN sd ON sd.k = b LEFT JOIN sb ON sb.k = b),
    weights AS (SELECT r, count(*) AS n, sum(g)::BIGINT AS g FROM df JOIN fixed USING (f) JOIN gains USING (k) GROUP BY r),
    scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(g, 0) AS weight,
               coalesce(g, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                 / 4294967296::DOUBLE)))::BIGINT AS score
               FROM dw LEFT JOIN weights USING (r)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
               count(*) OVER (PARTITION BY n_words >= {MIN_WORDS}) AS n FROM scored)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN n_words >= {MIN_WORDS} AND place <= {SHARE[0]} * n // {SHARE[1]} THEN place END AS rank FROM placed"""
