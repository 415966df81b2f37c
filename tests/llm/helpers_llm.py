"""Small fixtures for the operators of quarry.llm."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng: random.Random, n: int, stem: str = "") -> str:
    parts = ["ba", "co", "du", "fe", "gi", "ho", "ju", "ka", "lo", "mi", "nu", "pa", "re", "so", "ti"]
    return " ".join(stem + "".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n: int = 60, seed: int = 1):
    """Documents with copies, near copies, shared passages, odd and null rows."""
    rng = random.Random(seed)
    shared = prose(rng, 45)
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "de", "fr"])
        text = prose(rng, rng.randint(60, 150), {"en": "th", "de": "sch", "fr": "é"}[lang])
        if i % 5 == 0:
            text = f"{text}\n{shared}\n{prose(rng, 20)}"
        rows.append((i, text, lang, f"src{i % 3}", len(text)))
    rows.append((n, rows[3][1], "en", "src0", 1))                        # an exact copy
    rows.append((n + 1, rows[4][1] + " zzz", "de", "src1", 1))           # a near copy
    rows += [(n + 2, None, None, None, None), (n + 3, "", "en", "src2", 0), (n + 4, " \t\n ", "en", None, 4),
             (n + 5, "one", "fr", "src1", 3), (None, "no id at all", None, "src1", 5),
             (n + 6, "a b c " * 2000, "en", "src0", 12000), (n + 7, "éß\U0001F600 \x1c x y", "de", "src9", 9)]
    rows.append(rows[7])                                                 # a repeated row
    return rows


def docs_frame(spark, rows, extra: bool = False):
    df = spark.createDataFrame(rows, DOCS)
    if extra:                                                            # names the operators use themselves
        from pyspark.sql import functions as F
        for c in ("word", "fp", "root", "length", "rank", "task", "weight", "tokens", "topic", "q", "kept", "host",
                  "text_hash", "block", "id"):
            df = df.withColumn(c, F.lit("clash"))
    return df
