import hashlib
import random
import re
import string
from functools import reduce

import pytest
from pyspark.sql import functions as F

from snapflow.llm import secrets
from snapflow.llm.common import fold

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
HEX40 = hashlib.sha1(b"x").hexdigest()
ROWS = [
    (1, f'é🙂 token = "{HEX40}" end'), (2, "PASSWORD:abcdef, passwd='12345' api_key=zzzzzz apikey : ok"), (3, "AKIA" + "Z" * 16 + " AKIASHORT AKIAAKIA" + "Q" * 20),
    (4, "token:token:abcdefgh secret=token=abcdef"), (5, None), (6, ""), (7, "abcdef" * 4 + " " + "0" * 23), (8, f"{HEX40}{HEX40} {HEX40}g{HEX40}"),
    (8, f"{HEX40}{HEX40} {HEX40}g{HEX40}"), (None, "secret: hunter22"), (9, "ordinary words only, nothing here at all"), (10, " ".join(f"token=value{i:05d}" for i in range(300))),
    (11, "key aB3xQ9LmZ2pR7tVw4KsY8nHd and internationalizationConfiguration"),
]


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    words = [("".join(rng.choice(["tion", "re", "st", "ly", "an", "er", "con", "in", "ter", "na", "al", "iz", "fig", "ur", "Con", "ou", "he", "de"]) for _ in range(rng.randrange(2, 6)))) for _ in range(400)]
    return secrets.train(spark.createDataFrame([(i, " ".join(words[i:i + 40])) for i in range(360)], "doc_id long, text string"))


def test_spans(spark, model):
    docs = spark.createDataFrame([(*r, "old", i) for i, r in enumerate(ROWS)], "doc_id long, text string, secrets string, _base int")
    got = secrets.find(docs, model).withColumn("listed", secrets.listed(F.col("secrets"))).orderBy("_base").collect()
    assert len(got) == len(ROWS)
    for row, (doc_id, text) in zip(got, ROWS):
        spans = [tuple(s) for s in row["secrets"]]
        assert [s for s in spans if s[1] < 3] == base(text or ""), text
        assert row["listed"] == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans) and row["doc_id"] == doc_id
    odd = [s for s in got[-1]["secrets"] if s["kind"] == 3]
    assert [(s["start"], s["end"]) for s in odd] == [(4, 28)]


def test_markov_models_tell_random_from_ordinary(spark, model):
    rng = random.Random(5)
    random_words = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(28)) + "7" for _ in range(60)]
    ordinary = ["station_resting_contains_" + str(i) for i in range(60)]
    docs = spark.createDataFrame([(i, f"see {t} now") for i, t in enumerate(random_words + ordinary)], "doc_id int, text string")
    hits = {r["doc_id"] for r in secrets.find(docs, model).filter(F.size("secrets") > 0).collect()}
    assert len(hits & set(range(60))) >= 57 and not hits & set(range(60, 120))


def test_redaction(spark, model):
    docs = spark.createDataFrame([(i, r[1]) for i, r in enumerate(ROWS)], "doc_id int, text string")
    got = {r["doc_id"]: r["clean"] for r in secrets.find(docs, model).withColumn("clean", secrets.redact(F.col("text"), F.col("secrets"))).collect()}
    assert got[0] == 'é🙂 [SECRET]" end' and got[4] is None and got[5] == "" and got[10] == ROWS[10][1]
    assert got[11] == " ".join(["[SECRET]"] * 300) and got[12].startswith("key [SECRET] and internat")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.find(docs, secrets.train(docs)).count() == 0


def test_the_markov_models_alone_on_held_out_values(spark):
    """Values that the patterns find in documents the models have not seen, and random strings of other ids, judged by the
    models alone; beside them ordinary identifiers made of the same documents' words."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    unseen = fold("doc_id", 5) == 1
    model, held = secrets.train(docs.filter(~unseen)), docs.filter(unseen)
    table = F.split(F.lit(",".join(map(str, model.ratios))), ",").cast("array<double>")
    known = f"{secrets.ACCESS}|{secrets.HEX}"
    digest = F.base64(F.unhex(F.sha2(F.concat(F.lit("other"), "id").cast("binary"), 256)))
    words = held.select(F.explode(F.regexp_extract_all(F.regexp_replace("text", f"{secrets.ASSIGN}|{known}", " "), F.lit(secrets.IDENTIFIER), F.lit(0))).alias("s"))
    three = words.groupBy(F.xxhash64("s") % 10_000).agg(F.slice(F.array_sort(F.collect_set("s")), 1, 3).alias("w"))
    strings = [held.select(F.explode(F.regexp_extract_all("text", F.lit(known), F.lit(0))).alias("s"), F.lit("found").alias("kind")),
               held.select(F.explode(F.regexp_extract_all("text", F.lit(secrets.ASSIGN), F.lit(1))).alias("s"), F.lit("found").alias("kind")),
               spark.range(500).select(F.regexp_replace(F.substring(digest, 1, 32), "[+/=]", "x").alias("s"), F.lit("random").alias("kind")),
               three.select(F.array_join(F.transform("w", lambda x: F.initcap(x)), "").alias("s"), F.lit("camel").alias("kind")),
               three.select(F.concat(F.array_join("w", "_"), F.lit("_2")).alias("s"), F.lit("snake").alias("kind"))]
    rows = reduce(lambda a, b: a.union(b), strings).filter(F.length("s") >= 20)
    caught = secrets._ratio(F.col("s"), table) >= F.greatest(F.lit(model.total), model.mean * (F.length("s") - 1))
    share = {r["kind"]: (r["n"], r["c"] / r["n"]) for r in rows.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(caught).alias("c")).collect()}
    assert min(n for n, _ in share.values()) >= 20
    assert share["found"][1] >= 0.95 and share["random"][1] >= 0.95 and share["camel"][1] <= 0.002 and share["snake"][1] <= 0.002
