"""Operator 1: language identification by Bayesian evidence fusion.

Evidence of a page: the likelihood of its visible text under character trigram
profiles, the language its markup declares, the suffix of its address, and the prior
of its host.  How far declarations and suffixes can be trusted is learned: their
likelihoods per language come from grouped counts of the text posteriors.  Host
priors are smoothed hierarchically, host towards suffix towards all pages, by
grouped aggregation, without the page's own vote."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import mix64, small_side, text_slices
from tabmine.llm.extract import host_of
from tabmine.session import cut_lineage

#: hashed trigram space of a profile
BITS = 15
LANGUAGES = 64


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hashed trigram)`` of lower-cased letters; runs of other signs are one word edge."""
    joined = "\n" + "\n".join((t or "").lower().replace("\n", " ") for t in texts)      # every text begins with a word edge
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    row = np.cumsum(cp == 10) - 1
    code = np.where(_letters(cp), cp, 32)
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32) | (row[1:] != row[:-1])
    code, row = code[keep].astype(np.uint64), row[keep]
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = mix64((code[:-2] << np.uint64(42)) ^ (code[1:-1] << np.uint64(21)) ^ code[2:]) >> np.uint64(64 - BITS)
    ok = (row[:-2] == row[2:]) & ((code[1:-1] != 32) | (code[:-2] != 32))
    return row[:-2][ok], h[ok].astype(np.int64)


_LETTERS: list[np.ndarray] = []


def _letters(cp: np.ndarray) -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x3000)]))
    return np.where(cp < 0x3000, _LETTERS[0][np.minimum(cp, 0x2FFF)], True)


def fit_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and log P(trigram | language), from counts over all documents that name
    one.  The table has a fixed size per language; at most ``LANGUAGES`` are allowed."""
    named = docs.select(F.lower(F.trim(F.col(lang_col))).alias("l"), F.col(text_col).cast("string").alias("t"))
    named = named.where("l IS NOT NULL AND l <> ''")

    def run(batches):
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            at = 0
            for part in text_slices(batch.column("t"), 400_000):
                langs = batch.column("l").slice(at, len(part)).to_pylist()
                at += len(part)
                names = sorted(set(langs))
                rows, h = trigrams(part)
                which = np.array([names.index(x) for x in langs])[rows] if len(rows) else rows
                both = np.bincount(which * (1 << BITS) + h, minlength=len(names) << BITS).reshape(len(names), -1)
                for x, c in zip(names, both, strict=True):
                    seen[x] = seen.get(x, 0) + c
        for x, c in seen.items():
            k = np.flatnonzero(c)
            yield pd.DataFrame({"l": x, "k": k, "n": c[k]})

    counts = named.mapInArrow(_as_arrow(run), "l string, k int, n bigint").groupBy("l", "k").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts)
    langs = sorted(r.l for r in counts.select("l").distinct().limit(LANGUAGES + 1).collect())
    if len(langs) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages named")
    table = np.full((len(langs), 1 << BITS), 0.5)
    for x, k, n in counts.toPandas().itertuples(index=False):
        table[langs.index(x), k] += n
    return langs, np.log(table / table.sum(1, keepdims=True)) if len(langs) else table


def _as_arrow(run):
    def arrow(batches):
        for pdf in run(batches):
            yield pa.RecordBatch.from_pandas(pdf, schema=pa.schema([("l", pa.string()), ("k", pa.int32()), ("n", pa.int64())]),
                                             preserve_index=False)
    return arrow


def visible_text(html: F.Column) -> F.Column:
    """Text of a page without markup: enough for letters."""
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             host_weight: float = 4.0, suffix_weight: float = 20.0, text_scale: float = 0.2) -> DataFrame:
    """``(id, host, suffix, declared, text_lang, lang, confidence, n_host)`` per page.

    Text likelihoods are tempered by ``text_scale``, as neighbouring trigrams are not
    independent.  ``host_weight`` and ``suffix_weight`` are the pseudo-counts of the
    smoothing.  Null or empty pages have no text evidence and rest on the others; without
    any profile the language is null and the confidence 0.  Unknown declarations are a value like
    any other.  Repeated rows are kept; other columns are ignored."""
    langs, logp = fit_profiles(docs)
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("_id"), host_of(url_col).alias("host"), visible_text(html).alias("t"),
        F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]+)", 1)).alias("declared"))
    rows = rows.withColumn("suffix", F.regexp_extract("host", r"([^.]*)$", 1))
    kind = rows.schema["_id"].dataType.simpleString()

    def text_posterior(batches):
        for batch in batches:
            at = 0
            for part in text_slices(batch.column("t"), 400_000):
                r, h = trigrams(part)
                ll = np.stack([np.bincount(r, weights=w[h], minlength=len(part)) for w in logp], 1) if langs \
                    else np.zeros((len(part), 0))
                b = batch.slice(at, len(part))
                at += len(part)
                ll = text_scale * (ll - ll.max(1, keepdims=True)) if langs else ll
                post = np.exp(ll) / np.exp(ll).sum(1, keepdims=True) if langs else ll
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in keys], *[pa.array(list(x), pa.list_(pa.float64())) for x in (ll, post)]],
                    names=[*keys, "ll", "post"])

    keys = ["_id", "host", "declared", "suffix"]
    pages_ = cut_lineage(rows.mapInArrow(
        text_posterior, f"_id {kind}, host string, declared string, suffix string, ll array<double>, post array<double>"))
    if not langs:
        return pages_.select(F.col("_id").alias(id_col), "host", "suffix", "declared", F.lit(None).cast("string").alias("text_lang"),
                             F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), F.lit(0).cast("bigint").alias("n_host"))
    n = len(langs)

    def votes(*by: str) -> DataFrame:
        """Sums of the text posteriors per language in every group, and its rows."""
        sums = F.array(*[F.sum(F.col("post")[k]) for k in range(n)])
        return pages_.groupBy(*by).agg(sums.alias(f"v_{by[0]}" if by else "v"), F.count(F.lit(1)).alias(f"c_{by[0]}" if by else "c"))

    everything = votes().first()
    overall = np.array(everything["v"] if everything["c"] else [0.0] * n) + 1.0
    out = pages_
    for key in ("declared", "suffix", "host"):
        out = out.join(small_side(cut_lineage(votes(key)), 50_000), key)

    def fuse(batches):
        for batch in batches:
            ll, post, said, where, host = (np.array(batch.column(c).to_pylist(), dtype=float).reshape(batch.num_rows, n)
                                           for c in ("ll", "post", "v_declared", "v_suffix", "v_host"))
            rest = np.maximum(where - post, 0)           # a page's own vote does not count for itself
            by_suffix = rest + suffix_weight * overall / overall.sum()
            by_suffix /= by_suffix.sum(1, keepdims=True)
            by_host = np.maximum(host - post, 0) + host_weight * by_suffix
            by_host /= by_host.sum(1, keepdims=True)
            told = (np.maximum(said - post, 0) + 0.1) / (overall + 1.0)
            shown = (rest + 0.1) / (overall + 1.0)       # P(suffix | language); its prior share is in the host prior
            score = ll + np.log(told) + np.log(by_host) + 0.5 * (np.log(shown) - np.log(by_suffix))
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best, text = p.argmax(1), post.argmax(1)
            has = (post.max(1) > post.min(1)) | (n == 1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("_id", "host", "suffix", "declared")],
                 pa.array([langs[k] if h else None for k, h in zip(text, has, strict=True)], pa.string()),
                 pa.array([langs[k] for k in best], pa.string()), pa.array(p.max(1)), batch.column("c_host")],
                names=["_id", "host", "suffix", "declared", "text_lang", "lang", "confidence", "n_host"])

    fused = out.select(*keys, "ll", "post", "v_declared", "v_suffix", "v_host", "c_host").mapInArrow(
        fuse, f"_id {kind}, host string, suffix string, declared string, text_lang string, lang string, confidence double, n_host bigint")
    return fused.withColumnRenamed("_id", id_col)
