"""Operator 9: exact n-gram Jaccard join as a blocked sparse matrix product.

Rows of the matrix are distinct shingle sets, columns are shingles, and two sets
link when their Jaccard similarity reaches ``num / den``.  With sizes p and q
that means an overlap of at least (num / (num + den)) * (p + q), so at most
(den - num) / (den + num) * (p + q) shingles may differ: the size-derived bound.

1. Equal sets collapse to one row (a 64-bit set hash).
2. Blocking.  Sizes are cut into bands so that a linked pair lies in one band or
   in two neighbouring ones.  Within a band the columns are dealt into more parts than a
   linked pair may have differences, so a linked pair agrees on some whole parts.  Parts that are empty or
   hold common shingles alone (those seen twice or more in a bounded sample of the sets) say little and give no key, as long
   as a set has few of them; else the columns are dealt anew for it.  Sets that agree on a part are joined (a star per
   part, no pairs) and the connected sets form a block: pairs across blocks cannot link.
   Blocks that would need several tiles are split: within each, its sets are joined anew by their rarest shingles
   (those seen least in such blocks), of which linked sets share one.
3. Small blocks are put together.  Large ones are cut by size into bands, so that linked sets lie in one band
   or in neighbouring ones, and bands into tiles; tile pairs of bands farther apart are
   never made.  Each tile pair multiplies its two incidence matrices, accumulating overlap counts over
   column strips, and drops pairs below the size-derived bound.  A tile pair
   returns at most one spanning tree of links.
4. Connected components over the links.

No group is collected whole: keys are reduced in the tasks that find them before the
one shuffle of keys, and tiles hold a bounded number of shingles (one longer text aside)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.llm.common import components, mix64, small_side, text_chunks, tidy, word_hashes
from tabmine.operators.common import broadcast_checked
from tabmine.session import cut_lineage

#: shingles and sets of one tile of the product
TILE_SHINGLES, TILE_ROWS = 40_000, 256
#: keys that a task holds before it sends them on
KEYS_HELD = 200_000
#: sets on which common shingles are counted, in expectation, and how many of them are named at most
SAMPLE_SETS, COMMON = 8_000, 200_000
#: counters of the shingles of large blocks, how often such blocks are split at most, and how many further copies of
#: texts (for each set of the table) need no split
COUNTERS, SPLITS, SPARE_COPIES = 1 << 19, 4, 0.25
_C = [np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                             0x27D4EB2F165667C5, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03)]


def shingle_sets(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text: ``(row of each, hashes, set sizes)``,
    sorted by row and hash.  A text of fewer than ``width`` words has its whole
    sequence as one shingle; without words the set is empty."""
    words, row = word_hashes(data, starts)
    n_docs = len(starts)
    n_words = np.bincount(row, minlength=n_docs)
    mult = np.multiply.accumulate(np.full(width, _C[0], dtype=np.uint64))
    if len(words) >= width:
        m = len(words) - width + 1
        sh = np.zeros(m, dtype=np.uint64)
        for k in range(width):
            sh += words[k:k + m] * mult[k]
        sh = mix64(sh)
        inside = row[:m] == row[width - 1:]
        rows, sh = row[:m][inside], sh[inside]
    else:
        rows, sh = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    if len(short):
        first = np.searchsorted(row, short)
        whole = np.zeros(len(short), dtype=np.uint64)
        for k in range(width - 1):
            has = n_words[short] > k
            whole[has] += words[first[has] + k] * mult[k]
        whole = mix64(whole + n_words[short].astype(np.uint64) * _C[1])
        rows, sh = np.concatenate([rows, short]), np.concatenate([sh, whole])
    order = np.lexsort((sh, rows))
    rows, sh = rows[order], sh[order]
    keep = np.ones(len(sh), dtype=bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (sh[1:] != sh[:-1])
    rows, sh = rows[keep], sh[keep]
    return rows, sh, np.bincount(rows, minlength=n_docs)


def _set_ids(rows: np.ndarray, sh: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit id of every set: an order-free sum of remixed shingles and the size."""
    total = np.zeros(len(sizes), dtype=np.uint64)
    np.add.at(total, rows, mix64(sh ^ _C[2]))
    return mix64(total + sizes.astype(np.uint64) * _C[3]).view(np.int64)


def bands(num: int, den: int, top: int) -> np.ndarray:
    """First size of every band up to beyond ``top``: a set and one at most den / num
    times its size are in one band or in neighbouring ones."""
    lo = [1, 2]
    while lo[-2] <= top:
        lo.append(max(lo[-1] + 1, den * (lo[-1] - 1) // num + 1))
    return np.array(lo, dtype=np.int64)


def spare_parts(least: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Parts beyond d + 1 for sets of at least ``least`` shingles: half as many again as stay empty, and two deviations more."""
    m = np.zeros(len(d), dtype=np.int64)
    for _ in range(12):                                 # more parts leave more of them empty
        k = d + 1.0 + m
        empty = k * np.exp(-least / k)
        m = np.maximum(m, np.ceil(1.5 * empty + 2 * np.sqrt(empty))).astype(np.int64)
    return np.minimum(m, 2 * d + 2)


#: dealings of the columns that a set goes through while too many of its parts say little: whether a part of common
#: shingles alone says little too, or an empty one only; in the last every part is a key
DEALINGS = (True, True, False, False, None)


def part_keys(rows: np.ndarray, sh: np.ndarray, sizes: np.ndarray, num: int, den: int,
              common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys ``(row, key)`` of every set's parts, in its own band's division and in
    the next lower one's.  ``common``: sorted shingles that many sets have.

    A pair met in band b has at most d = floor((den - num) * (p + q) / (den + num))
    differences for the largest p, q of bands b and b + 1.  The columns are dealt
    into d + 1 + m parts, so m + 1 parts at least agree.  Parts that say little (empty, or of common
    shingles alone) give no key: if either set of the pair has at most m of them, another part agrees.  A set
    with more goes on to the next dealing, where the same holds; both sets of a pair that was not met go on.  d = 0
    needs no key: such sets are equal."""
    if not (sizes > 0).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo = bands(num, den, int(sizes.max()))
    own = np.searchsorted(lo, sizes, side="right") - 1
    every = np.arange(len(lo) - 2)
    top = (den - num) * ((lo[every + 1] - 1) + (lo[every + 2] - 1)) // (den + num)
    spare = spare_parts(lo[:-2].astype(float), top)
    rare = np.ones(len(sh), dtype=bool)
    if common is not None and len(common):
        rare = common[np.minimum(np.searchsorted(common, sh), len(common) - 1)] != sh
    out_rows, out_keys = [], []
    for band in (own, own - 1):
        b = np.clip(band, 0, len(every) - 1)
        parts = np.where((band >= 0) & (sizes > 0) & (top[b] > 0), top[b] + 1 + spare[b], 0)
        for turn, weak in enumerate(DEALINGS):
            offset = np.zeros(len(sizes) + 1, dtype=np.int64)
            np.cumsum(parts, out=offset[1:])
            if not offset[-1]:
                break
            take = np.flatnonzero(parts[rows] > 0)
            r, s = rows[take], sh[take]
            dealt = s if turn == 0 else mix64(s + np.uint64(turn * int(_C[3]) % 2**64))
            at = offset[r] + (((dealt >> np.uint64(32)) * parts[r].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            acc = np.zeros(offset[-1], dtype=np.uint64)
            np.add.at(acc, at, mix64(s ^ _C[4]))
            says = np.bincount(at[rare[take]] if weak else at, minlength=offset[-1]) > 0
            who = np.repeat(np.arange(len(sizes)), parts)
            which = np.arange(offset[-1]) - offset[who]
            use = says if weak is not None else np.ones(len(says), dtype=bool)
            salt = mix64(b[who].astype(np.uint64) * _C[5] + which.astype(np.uint64) * _C[6] + _C[7] + np.uint64(turn * int(_C[1]) % 2**64))
            out_rows.append(who[use])
            out_keys.append(mix64(acc[use] + salt[use] * _C[0]).view(np.int64))
            little = parts - np.bincount(who[says], minlength=len(sizes))
            parts = np.where(little > spare[b], parts, 0)
    return np.concatenate([np.zeros(0, np.int64), *out_rows]), np.concatenate([np.zeros(0, np.int64), *out_keys])


def rarest_keys(rows: np.ndarray, sh: np.ndarray, sizes: np.ndarray, num: int, den: int,
                seen: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys ``(row, key)``: of every set its p - ceil(num * p / den) + 1 shingles that come first in one order of all shingles,
    those counted least in ``seen`` before others.  Linked sets share ceil(num * p / den) shingles or more, for the p of
    either, so the first one that they share is a key of both, whatever the counts are."""
    order = np.lexsort((mix64(sh ^ np.uint64(salt)), seen[_counter(sh, len(seen), salt)], rows))
    rows, sh = rows[order], sh[order]
    first = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(np.bincount(rows, minlength=len(sizes)), out=first[1:])
    use = np.arange(len(rows)) - first[rows] < (sizes - -(-num * sizes // den) + 1)[rows]
    return rows[use], sh[use].view(np.int64)


def _counter(sh: np.ndarray, n: int, salt: int) -> np.ndarray:
    return (mix64(sh + np.uint64(salt)) % np.uint64(n)).astype(np.int64)


def seen_shingles(texts: DataFrame, width: int, salt: int) -> np.ndarray:
    """How often the shingles of ``texts(_text)`` occur, in eighths of a power of two, on ``COUNTERS`` counters that shingles share."""
    n = COUNTERS

    def run(batches):
        total = np.zeros(n, dtype=np.int64)
        for batch in batches:
            for _, data, starts in text_chunks(batch.column("_text")):
                np.add.at(total, _counter(shingle_sets(data, starts, width)[1], n, salt), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "n"])

    sums = texts.mapInArrow(tidy(run), "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).where("n > 1")
    found = sums.toArrow()
    seen = np.zeros(n, dtype=np.uint8)
    seen[found["at"].to_numpy()] = np.minimum(8 * np.log2(found["n"].to_numpy()), 255).astype(np.uint8)
    return seen


def common_shingles(texts: DataFrame, nodes: DataFrame, width: int) -> np.ndarray:
    """Shingles seen in two sets or more of a sample of about ``SAMPLE_SETS`` of ``nodes(node, _id)``, sorted: at most
    ``COMMON``, the most frequent.  They only decide which keys a set needs, so the sample has no part in which links are found."""
    n = nodes.count()
    level = F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1_000_000)) / 1_000_000
    ids = nodes.where(level < SAMPLE_SETS / max(n, 1)).where("_id IS NOT NULL").select("_id")
    sampled = texts.join(small_side(cut_lineage(ids)), "_id").groupBy("_id").agg(F.min("_text").alias("_text"))

    def run(batches):
        for batch in batches:
            for _, data, starts in text_chunks(batch.column("_text")):
                found, n = np.unique(shingle_sets(data, starts, width)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["s", "n"])

    seen = sampled.mapInArrow(tidy(run), "s bigint, n bigint").groupBy("s").agg(F.sum("n").alias("n")).where("n > 1")
    top = seen.orderBy(F.desc("n"), "s").limit(COMMON).select("s").toPandas()
    return np.sort(top["s"].to_numpy(np.int64).view(np.uint64))


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """Every input row with ``_n`` (set size) and ``_node`` (set id, null when empty)."""
    def run(batches):
        for batch in batches:
            out = []
            for i, data, starts in text_chunks(batch.column("_text")):
                rows, sh, sizes = shingle_sets(data, starts, width)
                out.append((sizes, _set_ids(rows, sh, sizes)))
            sizes = np.concatenate([o[0] for o in out]) if out else np.zeros(0, np.int64)
            ids = np.concatenate([o[1] for o in out]) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(sizes.astype(np.int64)), pa.array(ids, mask=sizes == 0)],
                names=["_id", "_n", "_node"])

    return texts.mapInArrow(tidy(run), "_id bigint, _n bigint, _node bigint")


def _keys(texts: DataFrame, width: int, num: int, den: int, common: np.ndarray | None = None, find=None) -> DataFrame:
    """``(key, node, other)`` of all keys: those of ``find(rows, shingles, sizes)``, or else of ``part_keys``; if ``texts`` has a column
    ``comp``, those of other blocks are other keys.  A task holds a bounded number of keys and sends
    each key on once, with its smallest set; the other sets that it met under the key go as
    links to that one (``other``, under a key of their own).  So a key has a row for each
    run of held keys at most, however many sets agree on it."""
    held, apart = KEYS_HELD, "comp" in texts.columns

    def parts(rows, sh, sizes):
        return part_keys(rows, sh, sizes, num, den, common)

    find = find or parts

    def reduced(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(keys, kind="stable")
        keys, nodes = keys[order], nodes[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        lo = np.minimum.reduceat(nodes, first)
        other = np.repeat(lo, np.diff(np.append(first, len(keys))))
        links = np.unique(np.stack([nodes, other], 1)[nodes != other], axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([keys[first], mix64(links[:, 0].view(np.uint64)).view(np.int64)])),
             pa.array(np.concatenate([lo, links[:, 0]])),
             pa.array(np.concatenate([lo, links[:, 1]]), mask=np.arange(len(lo) + len(links)) < len(lo))],
            names=["key", "node", "other"])

    def run(batches):
        seen: set[int] = set()
        keys, nodes, n = [], [], 0
        for batch in batches:
            for i, data, starts in text_chunks(batch.column("_text")):
                rows, sh, sizes = shingle_sets(data, starts, width)
                ids = _set_ids(rows, sh, sizes)
                fresh = np.zeros(len(ids), dtype=bool)
                for k, x in enumerate(ids.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[k] = True
                if len(seen) > 2_000_000:               # forgetting only repeats keys
                    seen.clear()
                keep = fresh[rows]
                who, key = find(rows[keep], sh[keep], np.where(fresh, sizes, 0))
                if len(who):
                    if apart:
                        block = batch.column("comp").slice(i, len(starts)).to_numpy(zero_copy_only=False).view(np.uint64)
                        key = mix64(key.view(np.uint64) ^ mix64(block ^ _C[5])[who]).view(np.int64)
                    keys.append(key)
                    nodes.append(ids[who])
                    n += len(who)
                if n > held:
                    yield reduced(np.concatenate(keys), np.concatenate(nodes))
                    keys, nodes, n = [], [], 0
        if n:
            yield reduced(np.concatenate(keys), np.concatenate(nodes))

    return texts.mapInArrow(tidy(run), "key bigint, node bigint, other bigint")


def _tile_links(width: int, num: int, den: int):
    """Links of one tile pair: product of the two incidence matrices by column strips."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tile", "node"], kind="stable").drop_duplicates("node")
        node, tile = pdf["node"].to_numpy(), pdf["tile"].to_numpy()
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        parts = [(at + r, s, z) for at, data, starts in text_chunks(pa.array(pdf["text"], pa.large_string()))
                 for r, s, z in [shingle_sets(data, starts, width)]]
        rows = np.concatenate([p[0] for p in parts])
        sh = np.concatenate([p[1] for p in parts])
        size = np.concatenate([p[2] for p in parts]).astype(np.int64)
        left = np.flatnonzero(tile == i)
        right = left if i == j else np.flatnonzero(tile == j)
        cols, inv, seen = np.unique(sh, return_inverse=True, return_counts=True)
        shared = seen[inv] > 1                          # a column of one row adds to no overlap
        rows, inv = rows[shared], inv[shared]
        used, inv = np.unique(inv, return_inverse=True)
        order = np.argsort(inv, kind="stable")
        rows, inv = rows[order], inv[order]
        overlap = np.zeros((len(left), len(right)), dtype=np.int64)
        strip = 4096
        for c in range(0, len(used), strip):
            a, b = np.searchsorted(inv, [c, c + strip])
            m = np.zeros((len(node), min(strip, len(used) - c)), dtype=np.float32)
            m[rows[a:b], inv[a:b] - c] = 1.0
            overlap += (m[left] @ m[right].T).astype(np.int64)
        ok = (num + den) * overlap >= num * (size[left][:, None] + size[right][None, :])
        ok &= overlap > 0
        x, y = np.nonzero(ok)
        x, y = left[x], right[y]
        up = list(range(len(node)))

        def find(v: int) -> int:
            while up[v] != v:
                up[v] = up[up[v]]
                v = up[v]
            return v

        out = []
        for p, q in zip(x.tolist(), y.tolist(), strict=True):
            if p != q and (rp := find(p)) != (rq := find(q)):
                up[rq] = rp
                out.append((node[p], node[q]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def jaccard_components(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = 3,
                       num: int = 90, den: int = 100) -> DataFrame:
    """``(id, n_shingles, component_id)`` per row of ``docs``: its set size and the
    smallest id reachable by links of Jaccard similarity >= num / den.

    Null and empty texts have empty sets and are linked with nothing (their
    component is their own id).  Rows of equal sets are linked.  Repeated rows are
    returned as often as they occur.  Rows with a null id link like others and get the
    smallest id they reach (null if none).  Other columns are ignored,
    so their names cannot clash; an empty table gives no rows."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    sets = cut_lineage(_sets(texts, width))
    links = _links(texts, sets, width, num, den)
    linked = cut_lineage(components(links))
    named = sets.where("_node IS NOT NULL").groupBy("_node").agg(F.min("_id").alias("_first"))
    named = cut_lineage(named.join(linked.withColumnRenamed("node", "_node"), "_node", "left")
                        .select("_node", "_first", F.coalesce("comp", "_node").alias("_comp")))
    first = cut_lineage(named.groupBy("_comp").agg(F.min("_first").alias("component_id")))
    named = cut_lineage(named.join(first, "_comp").select("_node", "component_id"))
    return sets.join(named, "_node", "left").select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"),
        F.when(F.col("_node").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"))


def _links(texts: DataFrame, sets: DataFrame, width: int, num: int, den: int) -> DataFrame:
    size = cut_lineage(sets.where("_node IS NOT NULL").groupBy(F.col("_node").alias("node")).agg(
        F.min("_id").alias("_id"), F.max("_n").alias("n")))
    blocks = components(_stars(_keys(texts, width, num, den, common_shingles(texts, size, width))))
    member = _split(texts, size.join(blocks, "node"), size.count(), width, num, den)
    near = _own_texts(texts, _placed(member, num, den), width)
    paired = near.select("node", F.col("_text").alias("text"), "g", "tile", F.explode("others").alias("o")).select(
        "node", "text", "g", "tile", F.least("tile", "o").alias("i"), F.greatest("tile", "o").alias("j"))
    return cut_lineage(paired.groupBy("g", "i", "j").applyInPandas(_tile_links(width, num, den), "a bigint, b bigint"))


def _stars(keys: DataFrame) -> DataFrame:
    """``(a, b)``: the sets of ``_keys`` that agree on a key, joined to the smallest of them."""
    least = F.min("node").over(Window.partitionBy("key"))
    return cut_lineage(keys.select(F.col("node").alias("a"), F.coalesce("other", least).alias("b")).where("a <> b").distinct())


def _own_texts(texts: DataFrame, of: DataFrame, width: int) -> DataFrame:
    """The rows of ``of(node, _rep, ...)`` (pinned) with ``_text``, a text of the set, instead of ``_rep``, its id."""
    rest = [c for c in of.columns if c not in ("node", "_rep")]
    near = texts.join(broadcast_checked(of.where("_rep IS NOT NULL"), 32 << 20), F.col("_id") == F.col("_rep"))
    # repeated ids may bring another text: only the text whose set is the node's is used
    near = _only_own(near.select("node", "_text", *rest), width)
    nameless = of.where("_rep IS NULL")                 # sets of rows without an id
    if not nameless.isEmpty():
        rows = _with_node(texts.where("_id IS NULL"), width).groupBy("node").agg(F.min("_text").alias("_text"))
        near = near.unionByName(rows.join(nameless, "node").select(*near.columns))
    return near


def _big(m: str, w: str) -> F.Column:
    """Whether a block of so many sets and shingles is cut into tiles."""
    return (F.col(w) > TILE_SHINGLES) | (F.col(m) > TILE_ROWS)


def _split(texts: DataFrame, member: DataFrame, n_sets: int, width: int, num: int, den: int) -> DataFrame:
    """``member(node, _id, n, comp)`` with the blocks that tiles would cut split by ``rarest_keys``, as long as their sets go to
    many tiles and that helps.  Every set of such a block goes to all its tiles, so strangers joined by chance into ever
    larger blocks, as tables grow, would be copied more often each.  Sets that agree with none are linked with none and go."""
    member, own, before = cut_lineage(member), None, None
    for turn in range(1, SPLITS + 1):
        blocks = cut_lineage(member.groupBy("comp").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("m")).where(_big("m", "w")))
        more = F.col("m") * F.floor(F.greatest(F.col("w") / TILE_SHINGLES, F.col("m") / TILE_ROWS))
        copies = blocks.agg(F.sum(more)).first()[0] or 0
        if copies <= SPARE_COPIES * n_sets or before is not None and copies > before // 2:
            break
        blocks = blocks.select("comp")
        inside = cut_lineage(member.join(blocks, "comp", "left_semi").select("node", "_id", "n", "comp"))
        if own is None:
            own = cut_lineage(_own_texts(texts, inside.select("node", F.col("_id").alias("_rep")), width))
        here = own.join(inside.select("node", "comp"), "node").select("_text", "comp")
        seen = seen_shingles(here, width, turn)

        def rarest(rows, sh, sizes, seen=seen, turn=turn):
            return rarest_keys(rows, sh, sizes, num, den, seen, turn)

        apart = components(_stars(_keys(here, width, num, den, find=rarest)))
        member = cut_lineage(member.join(blocks, "comp", "left_anti").select("node", "_id", "n", "comp").unionByName(
            inside.drop("comp").join(apart, "node")))
        before = copies
    return member


def _placed(member: DataFrame, num: int, den: int) -> DataFrame:
    """``(node, _rep, g, tile, others)`` of the sets of ``member(node, _id, n, comp)`` (pinned): the group of tiles and the tile
    that a set is put into, and the tiles that meet it.  Small blocks share tiles; a large block has its own
    group, whose tiles are numbered by size band."""
    member = cut_lineage(member)
    top = member.agg(F.max("n")).first()[0] or 1
    member = cut_lineage(member.withColumn("band", _band(F.col("n"), num, den, top)))
    block = member.groupBy("comp").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("m"))
    block = cut_lineage(block.select("comp", "w", _big("m", "w").alias("big")))
    bins = max(1, int((block.where("NOT big").agg(F.sum("w")).first()[0] or 0) // TILE_SHINGLES) + 1)
    cut = member.join(block.where("big").select("comp"), "comp", "left_semi").groupBy("comp", "band").agg(
        F.ceil(F.greatest(F.sum("n") / TILE_SHINGLES, F.count(F.lit(1)) / TILE_ROWS)).cast("int").alias("tiles"))
    cut = cut_lineage(cut)
    below = cut.select("comp", (F.col("band") + 1).alias("band"), F.col("tiles").alias("below"))
    above = cut.select("comp", (F.col("band") - 1).alias("band"), F.col("tiles").alias("above"))
    cut = cut_lineage(cut.join(below, ["comp", "band"], "left").join(above, ["comp", "band"], "left"))

    def tiles(band: F.Column, n: str) -> F.Column:      # a tile is numbered by its band and its place there
        return F.when(F.col(n) > 0, F.transform(F.sequence(F.lit(0), F.col(n) - 1), lambda k: band * F.lit(1 << 32) + k)).otherwise(
            F.array().cast("array<bigint>"))

    band = F.col("band").cast("bigint")
    big = F.col("tiles").isNotNull()
    own = band * F.lit(1 << 32) + F.pmod(F.xxhash64("node", F.lit(11)), F.col("tiles"))
    met = F.concat(tiles(band - 1, "below"), tiles(band, "tiles"), tiles(band + 1, "above"))
    placed = member.join(cut, ["comp", "band"], "left").select(
        "node", F.col("_id").alias("_rep"),
        F.when(big, F.concat(F.lit("b"), F.col("comp").cast("string"))).otherwise(F.concat(F.lit("s"), F.pmod(F.xxhash64("comp", F.lit(7)), F.lit(bins)).cast("string"))).alias("g"),
        F.when(big, own).otherwise(F.lit(0).cast("bigint")).alias("tile"),
        F.when(big, met).otherwise(F.array(F.lit(0).cast("bigint"))).alias("others"))
    return cut_lineage(placed)


def _band(n: F.Column, num: int, den: int, top: int) -> F.Column:
    """Number of the band of a size up to ``top``."""
    return F.size(F.filter(F.array(*[F.lit(int(x)) for x in bands(num, den, top)]), lambda x: x <= n)) - 1


def _with_node(texts: DataFrame, width: int) -> DataFrame:
    """``(node, _text)`` of the texts that have a set."""
    def run(batches):
        for batch in batches:
            for i, data, starts in text_chunks(batch.column("_text")):
                rows, sh, sizes = shingle_sets(data, starts, width)
                node = pa.array(_set_ids(rows, sh, sizes), mask=sizes == 0)
                yield pa.RecordBatch.from_arrays([node, batch.column("_text").slice(i, len(starts))], names=["node", "_text"])

    return texts.select("_text").mapInArrow(tidy(run), "node bigint, _text string").where("node IS NOT NULL")


def _only_own(near: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            keep = []
            node = batch.column("node").to_numpy(zero_copy_only=False)
            for i, data, starts in text_chunks(batch.column("_text")):
                rows, sh, sizes = shingle_sets(data, starts, width)
                keep.append(_set_ids(rows, sh, sizes) == node[i:i + len(sizes)])
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return near.mapInArrow(tidy(run), near.schema)
