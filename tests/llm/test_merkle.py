import hashlib
import random

from pyspark.sql import functions as F

from tabmine.llm.merkle import fingerprints, with_next

SCHEMA = "doc_id bigint, text string"


def ring(rows):
    """Next text by falling id, ties by the hash of the text."""
    live = sorted([(i, t or "") for i, t in rows if i is not None], key=lambda r: (-r[0], hashlib.sha256(r[1].encode()).hexdigest()))
    return [(i, t, live[(k + 1) % len(live)][1]) for k, (i, t) in enumerate(live)] + [(None, t or "", "") for i, t in rows if i is None]


def edited(text, nxt):
    half = len(text) // 2
    return text[:len(text) - half] + nxt[:half]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sample(n=400, seed=1):
    rng = random.Random(seed)
    words = ["été", "the", "and", "word", "😀", "line", "Straße", "plain", "text", "cut"]
    rows = []
    for i in range(n):
        paragraphs = [" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(rng.randrange(1, 12))]
        rows.append((rng.choice([i * 37, i * 90_000, -i]), "\n".join(paragraphs)))
    return rows


def test_neighbours_and_edits(spark):
    rows = sample() + [(1, None), (2, ""), (5_000_000_000, "x")]
    want = sorted((i, t, n) for i, t, n in ring(rows))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, with_next(df, "text", "doc_id").collect())) == want
    got = sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint == r.edited_fingerprint) for r in fingerprints(df).collect())
    assert got == sorted((i, len(t), sha(edited(t, n)), t == edited(t, n)) for i, t, n in want)


def test_equal_texts_equal_roots_and_likeness(spark):
    rows = sample(200, 3)
    got = {r.doc_id: r for r in fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    texts = dict(rows)
    by_text, by_root = {}, {}
    for i, r in got.items():
        by_text.setdefault(texts[i], set()).add(r.fingerprint)
        by_root.setdefault(r.fingerprint, set()).add(texts[i])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in [*by_text.values(), *by_root.values()])


def test_branches_locate_the_edit(spark):
    text = "\n".join(f"paragraph number {k} has its own words {k * k}" for k in range(40))
    got = fingerprints(spark.createDataFrame([(2, text), (1, "other " * 400)], SCHEMA)).where("doc_id = 2").first()
    kept = len(edited(text, "")) // len(text.split("\n")[0])
    assert got.n_paragraphs == 40 and min(got.edited_paragraphs) >= kept - 8 and max(got.edited_paragraphs) == 39
    assert 0.3 < got.near_edited < 0.7 and got.near_next < 0.1


def test_edges(spark):
    rows = [(7, "same\ntext"), (7, "same\ntext"), (None, "a\nb"), (None, None), (3, "\n" * 20_000), (4, "w " * 200_000), (9, "")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.lit(-1)).withColumn("_b", F.lit("x"))
    got = fingerprints(df).collect()
    assert len(got) == 7
    want = sorted((str(i), sha(edited(t, n))) for i, t, n in ring(rows))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in got) == want
    assert next(r for r in got if r.doc_id == 9).near_edited == 1.0
    assert fingerprints(df.limit(0)).collect() == []
    one = fingerprints(spark.createDataFrame([(1, "abcd")], SCHEMA)).first()
    assert one.edited_sha256 == sha("abab") and one.near_next == 1.0
