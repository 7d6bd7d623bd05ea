import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from tabmine.llm.langid import BITS, identify

SF = "/root/testdata/sf0.01"
WORDS = {"en": "the and with house this that water from".split(), "de": "der und nicht haus dieser wasser von schön".split(),
         "fr": "le et avec maison cette eau dans être".split()}
PAGE = "page_id bigint, url string, html string"


def profiles(spark):
    rng = random.Random(1)
    return spark.createDataFrame([(i, " ".join(rng.choices(w, k=80)), x) for i, (x, w) in enumerate(list(WORDS.items()) * 5)],
                                 "doc_id bigint, text string, lang string")


def page(lang, words, declared, rng):
    return f'<!DOCTYPE html><html lang="{declared}"><head><script>the and with the</script></head><body><p>{" ".join(rng.choices(WORDS[lang], k=words))}</p></body></html>'


def test_text_decides_over_wrong_markup(spark):
    rng = random.Random(2)
    rows = [(i, f"http://h{i % 7}.example.com/{i}", page(x, 40, "en", rng)) for i, x in enumerate(["en", "de", "fr"] * 30)]
    got = {r.page_id: r for r in identify(spark.createDataFrame(rows, PAGE), profiles(spark)).collect()}
    assert all(got[i].lang == x and got[i].text_lang == x for i, x in enumerate(["en", "de", "fr"] * 30))


def test_host_and_declaration_decide_without_text(spark):
    rng = random.Random(3)
    rows = [(i, f"http://{x}.example.{x}/{i}", page(x, 40, x, rng)) for i, x in enumerate(["en", "de", "fr"] * 30)]
    rows += [(900, "http://de.example.de/x", "<p>123</p>"), (901, "http://new.example.org/", '<html lang=fr><p>1'), (902, None, None)]
    got = {r.page_id: r for r in identify(spark.createDataFrame(rows, PAGE), profiles(spark)).collect()}
    assert got[900].lang == "de" and got[901].lang == "fr" and got[902].lang is not None
    assert got[900].text_lang is None and got[900].confidence > 0.8


def test_own_vote_does_not_count(spark):
    """One-page hosts: the host prior is the suffix prior, recomputed here from the parts returned."""
    rng = random.Random(5)
    rows = [(i, f"http://h{i}.example.com/", page(x, 30, "xx", rng)) for i, x in enumerate(["en", "de"] * 10)]
    got = identify(spark.createDataFrame(rows, PAGE), profiles(spark)).collect()
    counts = defaultdict(int)
    for r in got:
        counts[r.lang] += 1
        assert r.n_host == 1 and 0 < r.confidence <= 1 and not math.isnan(r.confidence)
    assert counts == {"en": 10, "de": 10}


def test_edges(spark):
    rows = [(1, "http://h/", None), (1, "http://h/", None), (None, "//x", ""), (2, "bad", "<html lang>" + "wort " * 200_000), (3, "", "😀")]
    df = spark.createDataFrame(rows, PAGE).selectExpr("*", "1 AS host", "2 AS lang", "3 AS t")
    assert identify(df, profiles(spark)).count() == 5
    assert identify(df.limit(0), profiles(spark)).collect() == []
    none = identify(df, profiles(spark).limit(0)).collect()
    assert len(none) == 5 and all(r.lang is None and r.confidence == 0 for r in none)


def test_pages_of_the_table(spark):
    """The generated pages name their language in the address; most of them are right."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = identify(pages, spark.read.parquet(f"{SF}/documents.parquet"))
    truth = pages.select("page_id", F.regexp_extract("url", r"://[^/]*/([a-z]{2})/", 1).alias("truth"))
    both = got.join(truth, "page_id").where("truth <> ''").select(F.avg((F.col("lang") == F.col("truth")).cast("int"))).first()[0]
    assert both > 0.95


def plain_trigrams(text):
    """Hashed trigrams of letters, one edge for any run of other signs."""
    signs = [" "]
    for c in (text or "").lower():
        c = c if c.isalpha() else " "
        if c != " " or signs[-1] != " ":
            signs.append(c)
    out, mask = [], 2**64 - 1
    for a, b, c in zip(signs, signs[1:], signs[2:]):
        if (a, b) != (" ", " "):
            x = (ord(a) << 42) ^ (ord(b) << 21) ^ ord(c)
            x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
            x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
            out.append((x ^ (x >> 31)) >> (64 - BITS))
    return out


def plain_identify(pages, docs):
    """Every step by loops: profiles, tempered posteriors, votes without the page's own, smoothed host prior, fusion."""
    langs = sorted({x for _, _, x in docs})
    count = {x: defaultdict(float) for x in langs}
    for _, t, x in docs:
        for h in plain_trigrams(t):
            count[x][h] += 1
    size = {x: sum(count[x].values()) + 0.5 * 2**BITS for x in langs}

    def shares(v):
        return [x / sum(v) for x in v]

    rows = []
    for i, url, host, suffix, declared, text in pages:
        ll = [sum(math.log((count[x][h] + 0.5) / size[x]) for h in plain_trigrams(text)) for x in langs]
        ll = [0.2 * (v - max(ll)) for v in ll]
        rows.append((i, host, suffix, declared, ll, shares([math.exp(v) for v in ll])))
    n = range(len(langs))
    overall = [1 + sum(r[5][k] for r in rows) for k in n]
    out = {}
    for r in rows:
        def votes(at, r=r):
            return [max(sum(o[5][k] for o in rows if o[at] == r[at] and o is not r), 0.0) for k in n]

        here, at_suffix, said = votes(1), votes(2), votes(3)
        by_suffix = shares([v + 20 * o / sum(overall) for v, o in zip(at_suffix, overall)])
        by_host = shares([v + 4 * q for v, q in zip(here, by_suffix)])
        score = [r[4][k] + math.log((said[k] + 0.1) / (overall[k] + 1)) + math.log(by_host[k])
                 + 0.5 * (math.log((at_suffix[k] + 0.1) / (overall[k] + 1)) - math.log(by_suffix[k])) for k in n]
        p = shares([math.exp(v - max(score)) for v in score])
        out[r[0]] = (langs[p.index(max(p))], max(p))
    return out


def test_against_a_plain_version(spark):
    rng = random.Random(11)
    docs = [tuple(r) for r in profiles(spark).collect()]
    pages, rows = [], []
    for i in range(70):
        lang = rng.choice(["en", "de", "fr"])
        host, suffix = rng.choice([("a.x.de", "de"), ("b.x.de", "de"), ("c.org", "org"), (f"h{i}.fr", "fr")])
        declared = rng.choice([lang, "en", ""])
        text = " ".join(rng.choices(WORDS[lang], k=rng.choice([0, 1, 2, 5]))) + rng.choice(["", " 12", "!"])
        tag = f'<html lang="{declared}">' if declared else "<html>"
        pages.append((i, f"http://{host}/{i}", host, suffix, declared, f" {text} "))      # tags become spaces
        rows.append((i, f"http://{host}/{i}", f"{tag}<body>{text}</body>"))
    got = {r.page_id: r for r in identify(spark.createDataFrame(rows, PAGE).repartition(4), profiles(spark)).collect()}
    want = plain_identify(pages, docs)
    assert got.keys() == want.keys()
    for i, (lang, p) in want.items():
        assert got[i].lang == lang and abs(got[i].confidence - p) < 1e-9, (i, got[i], lang, p)
    assert len({r.lang for r in got.values()}) == 3
