import random

import corpus_pipeline
from pyspark.sql import functions as F

from tabmine.llm.quality import score_quality
from tabmine.llm.toxicity import score_toxicity
from tests.llm.test_jaccard import brute
from tests.llm.test_packing import check

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, source string, lang string"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r.doc_id for r in score_toxicity(docs, labels).where("predicted = 1").collect()}
    kept = docs.where(~F.col("doc_id").isin(list(toxic)))
    good = {r.doc_id for r in score_quality(kept, labels).where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in kept.collect() if r.doc_id in good]
    first = {d for d, _, c in brute([r[:2] for r in rows], 5, 80, 100) if d == c}
    got = corpus_pipeline.run(spark, SF).collect()
    rows = [r for r in rows if r[0] in first]
    seen = check(rows, got, 2048)
    assert seen == {r[0]: -(-len(r[1].encode()) // 4) for r in rows}


def test_columns_and_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    twice = docs.unionByName(docs.limit(30))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, twice, SF).columns == docs.columns, name
    kept = corpus_pipeline.drop_near_copies(spark, twice, SF)
    assert kept.count() == kept.select("doc_id").distinct().count()
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, corpus_pipeline.drop_near_copies(spark, docs, SF).collect()))


def test_near_copies_by_five_words_and_four_fifths(spark):
    rng = random.Random(4)
    rows = []
    for k in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows.append((2 * k, " ".join(words), "s", "en"))
        at = rng.randrange(150)
        words[at:at + k // 2] = [f"e{rng.randrange(5000)}" for _ in range(k // 2)]
        rows.append((2 * k + 1, " ".join(words), "s", "en"))
    docs = spark.createDataFrame(rows, SCHEMA)
    want = [d for d, _, c in brute([r[:2] for r in rows], 5, 80, 100) if d == c]
    narrow = [d for d, _, c in brute([r[:2] for r in rows]) if d == c]
    assert len(want) < len(narrow)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()) == sorted(want)


def test_unlinked_texts_of_one_id_stay(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(12)]
    rows = [(7, t, f"s{k}", "en") for k, t in enumerate(texts)]                # one id, different texts
    rows += rows[:5]                                                           # repeated rows
    near = [(7, texts[0] + " more", "s", "en"), (9, texts[1] + " more", "s", "en"), (3, texts[2] + " more", "s", "en"), (3, "x", "s", "en")]
    alone = [(None, texts[3], "s", "en"), (None, texts[3], "s", "en"), (8, None, "s", "en"), (8, "", "s", "en"), (8, "", "s", "en")]
    docs = spark.createDataFrame(rows + near + alone, SCHEMA).repartition(4)
    got = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert got.columns == docs.columns
    want = [(7, t) for k, t in enumerate(texts) if k != 2] + [near[2][:2], near[3][:2]] + [(None, texts[3])] * 2 + [(8, None), (8, "")]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
