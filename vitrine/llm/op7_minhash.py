"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A document's set is its distinct shingles of five words.  Two permutations of the 32-bit numbers, sigma and
pi, give all coordinates: coordinate k is the smallest value of pi over the set's images under
sigma, shifted round by the k-th step.  ``BANDS`` bands of ``ROWS`` coordinates are
hashed; documents that share a band are candidates, and a candidate pair becomes a link only when the full sets
of the two texts say so.  With 42 bands of 6 a pair at 0.85 is missed with probability 2e-9, at 0.80 with 3e-6.

Texts that are equal word for word are one class and are handled once.  No pairs are listed within a band.  First every
member is checked against one centre, the member that shares most bands with others, which for edited copies is their
original.  These checks tell links, and also every member's distance from the centre.  Distance, one less the
similarity, is a metric: members whose distances from the centre differ by more than a link may be apart are no link.  So a band falls into
cells by that distance, only neighbouring cells can hold a link, and cells all of one component are done.

What is left is compared in blocks.  A first pass compares signatures, and names the members that have a candidate in another component,
with no word of which; a pair counts in the first band it shares.  A second pass brings the texts of these members
together, intersects their full sets as products of 0/1 matrices, and lists links that join components: a forest, so at most one link a member.

Defined cases: a null or empty text has no shingles, is linked with nothing and kept; fewer than five words are one
shingle; rows without an id take part and are never chosen over rows with one; equal rows are one class;
an empty table gives no rows; further columns are carried along by ``keep_one``.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import components, encoded, fresh, table
from vitrine.session import cut_lineage

SHINGLE, BANDS, ROWS = 5, 42, 6
COORDINATES = BANDS * ROWS
#: An estimate this far below the threshold is still verified: four deviations of the mean of 252 coordinates.
REACH = 0.10
#: Members of a band whose signatures are compared as one block; members, and shingles of all of them, whose texts are.
BLOCK, TEXTS, TEXT_SHINGLES = 4096, 512, 200_000
#: Odd steps and multipliers of the permutations.
STEP, SIGMA, PI = 0x9E3779B1, (0x85EBCA6B, 0xC2B2AE35), (0x2C1B3C6D, 0x297A2D39)
_SHIFTS = (np.arange(1, COORDINATES + 1, dtype=np.uint64) * STEP).astype(np.uint32)


def normal(raw: bytes) -> tuple[bytes, set[bytes]]:
    """The words of a text, A-Z lowered, joined by a space; and its set of shingles."""
    words = raw.lower().split()
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return joined, {joined} if words else set()
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    return joined, {joined[a : b - 1] for a, b in zip(starts, starts[SHINGLE:])}


def _mixed(x: np.ndarray, by: tuple[int, int]) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(by[0])
    x ^= x >> np.uint32(15)
    x *= np.uint32(by[1])
    return x


def signature(shingles: set[bytes]) -> np.ndarray:
    """The coordinates, sixteen bits of each."""
    ids = np.fromiter(map(zlib.crc32, shingles), dtype=np.uint32, count=len(shingles))
    images = _mixed(ids, SIGMA)
    low = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(images), 512):
        shifted = images[at : at + 512, None] + _SHIFTS
        np.minimum(low, _mixed(shifted, PI).min(axis=0), out=low)
    return (low ^ (low >> np.uint32(16))).astype(np.uint16)


SIGNED = "key binary, n long, sig binary"


def _signed(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for raw in encoded(texts):
        joined, shingles = normal(raw)
        rows.append((hashlib.md5(joined).digest(), len(shingles), signature(shingles).tobytes()) if shingles else (None, 0, None))
    return pd.DataFrame(rows, columns=["key", "n", "sig"])


def _bands(sigs: pd.Series) -> pd.Series:
    multipliers = (np.arange(1, ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    out = []
    for sig in sigs:
        rows = np.frombuffer(sig, dtype=np.uint16).reshape(BANDS, ROWS).astype(np.uint64)
        x = np.arange(1, BANDS + 1, dtype=np.uint64)
        for i in range(ROWS):
            x = (x ^ rows[:, i]) * multipliers[i]
            x ^= x >> np.uint64(29)
        out.append(x.view(np.int64))
    return pd.Series(out)


def row_key(id_col: str, text_col: str) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def checked(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``common`` and ``total``, the sizes of the intersection and the union of their full sets."""

    def sizes(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        out, kept = [], {}
        for a, b in zip(left, right):
            if a not in kept:
                kept.clear()  # rows come sorted by their centre
                kept[a] = normal(a.encode())[1]
            x, y = kept[a], normal(b.encode())[1]
            common = len(x & y)
            out.append((common, len(x) + len(y) - common))
        return pd.DataFrame(out, columns=["common", "total"])

    sizes.__annotations__ = {"left": pd.Series, "right": pd.Series, "return": pd.DataFrame}
    joined = pairs.join(bodies.select(F.col("key").alias("b"), F.col("body").alias("tb")), "b").join(bodies.select(F.col("key").alias("a"), F.col("body").alias("ta")), "a")
    return joined.select("a", "b", F.pandas_udf(sizes, "common long, total long")("ta", "tb").alias("s")).select("a", "b", "s.*")


def in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """``rows`` of bands dealt in blocks, each copied to every pair of blocks (i, j) it is in; small bands share a ``pack``."""
    dealt = rows.withColumn("blocks", blocks.cast("int")).withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    packs = max(1, rows.count() // 4000)
    return dealt.withColumn("pack", F.pmod(F.xxhash64("band", "i", "j"), F.lit(packs)))


def sides(frame: pd.DataFrame):
    """(rows, places of block i, places of block j) of each pair of blocks in a pack."""
    for _, part in frame.groupby(["band", "i", "j"], sort=False).indices.items():
        rows = frame.take(part)
        block, i, j = rows["own"].to_numpy(), rows["i"].iloc[0], rows["j"].iloc[0]
        yield rows, np.flatnonzero(block == i), np.flatnonzero(block == j)


def with_candidates(rest: DataFrame, percent: int) -> DataFrame:
    """(band, key) of the members that have a candidate, by signature, in another component and a neighbouring cell.

    ``rest`` has band, nth, m (members left in the band), key, comp, cell, n and sig.
    """
    reach = percent / 100 - REACH

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for rows, left, right in sides(frame):
            sigs = np.frombuffer(b"".join(rows["sig"]), dtype=np.uint16).reshape(-1, COORDINATES)
            size, cell, nth = rows["n"].to_numpy(), rows["cell"].to_numpy(), rows["nth"].iloc[0]
            comp = pd.factorize(rows["comp"])[0]
            named = np.zeros(len(rows), dtype=bool)
            for nr, x in enumerate(left):
                ys = right if left[0] != right[0] else right[nr + 1 :]
                ys = ys[(comp[ys] != comp[x]) & (np.abs(cell[ys] - cell[x]) <= 1) & (100 * np.minimum(size[ys], size[x]) >= percent * np.maximum(size[ys], size[x]))]
                if len(ys):
                    same = sigs[ys] == sigs[x]
                    close = same.mean(axis=1) >= reach
                    # A pair is told by the first band it shares, not by each.
                    mine = ys[close][same[close].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == nth]
                    if len(mine):
                        named[x] = True
                        named[mine] = True
            out.append(rows.loc[named, ["band", "key"]])
        return pd.concat(out)

    columns = in_blocks(rest, F.ceil(F.col("m") / BLOCK)).select("pack", "band", "nth", "i", "j", "own", "key", "comp", "cell", "n", "sig")
    return columns.groupBy("pack").applyInPandas(compare, "band long, key binary").distinct()


def intersections(sets: list[set], left: np.ndarray, right: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of the ``left`` sets with other, ``right`` ones: products of 0/1 matrices, exact below 2^24."""
    number: dict = {}
    often: list[int] = []
    at, what = [], []
    for k, shingles in enumerate(sets):
        for shingle in shingles:
            i = number.setdefault(shingle, len(number))
            if i == len(often):
                often.append(0)
            often[i] += 1
            at.append(k)
            what.append(i)
    at, what = np.array(at, dtype=np.int64), np.array(what, dtype=np.int64)
    shared = np.array(often, dtype=np.int64) > 1  # what stands in one set alone is in no intersection
    place = np.cumsum(shared) - 1
    keep = shared[what] if len(what) else np.zeros(0, dtype=bool)
    at, what = at[keep], place[what[keep]]
    order = np.argsort(what, kind="stable")
    at, what = at[order], what[order]
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    for start in range(0, int(what[-1]) + 1 if len(what) else 0, columns):
        a, b = np.searchsorted(what, (start, start + columns))
        ones = np.zeros((len(sets), columns), dtype=np.float32)
        ones[at[a:b], what[a:b] - start] = 1.0
        out += ones[left] @ ones[right].T
    return out


def forest(rest: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join different components within blocks of ``rest`` (band, key, comp, n, m, words): at most one a member and pair of blocks."""

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for rows, left, right in sides(frame):
            sets = [normal(t.encode())[1] for t in rows["body"]]
            size = np.array([len(x) for x in sets])
            common = intersections(sets, left, right)
            linked = 100 * common >= percent * (size[left][:, None] + size[right][None, :] - common)
            root = dict(enumerate(pd.factorize(rows["comp"])[0].tolist()))
            above: dict[int, int] = {}

            def find(c: int) -> int:
                while c in above:
                    above[c] = c = above.get(above[c], above[c])
                return c

            for x, y in zip(*np.nonzero(linked)):
                p, q = find(root[left[x]]), find(root[right[y]])
                if p != q:
                    above[p] = q
                    out.append((rows["key"].iat[left[x]], rows["key"].iat[right[y]]))
        return pd.DataFrame(out, columns=["a", "b"])

    # A block holds few enough members, and few enough shingles, for one task.
    blocks = F.greatest(F.ceil(F.col("m") / TEXTS), F.ceil(F.col("words") / TEXT_SHINGLES))
    columns = in_blocks(rest, blocks).join(bodies, "key").select("pack", "band", "i", "j", "own", "key", "comp", "body")
    return columns.groupBy("pack").applyInPandas(join, "a binary, b binary").distinct()


def grouped(reps: DataFrame, bodies_of, percent: int) -> DataFrame:
    """(node, root) of the classes that are linked with others; root is the smallest of its component.

    ``bodies_of`` turns keys into (key, body), the texts of those classes.
    """
    bands = reps.select("key", F.posexplode(F.pandas_udf(_annotated(_bands, pd.Series, pd.Series), "array<long>")("sig")).alias("nth", "band"))
    sizes = bands.groupBy("band").agg(F.count("*").alias("m")).filter("m > 1")
    members = cut_lineage(bands.join(sizes, "band"), "members")
    bodies = cut_lineage(bodies_of(members.select("key").distinct()), "bodies")
    central = members.groupBy("key").agg(F.sum("m").alias("weight"))
    centred = cut_lineage(members.join(central, "key").groupBy("band").agg(F.max(F.struct("weight", "key"))["key"].alias("a")), "centres")
    centred = members.select("band", "nth", "key").join(centred, "band")
    stars = centred.filter("a != key").select("a", F.col("key").alias("b")).distinct()
    seen = cut_lineage(checked(stars, bodies), "stars")
    found = cut_lineage(seen.filter(F.expr(f"100 * common >= {percent} * total")).select("a", "b"), "star_links")

    joined = cut_lineage(components(found), "components")
    split = centred.join(joined.select(F.col("node").alias("key"), F.col("root").alias("comp")), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    # Whole cells of the width of a link: links lie within a cell or between neighbours.
    cell = F.floor(100 * (F.col("total") - F.col("common")) / F.greatest(F.col("total") * (100 - percent), F.lit(1)))
    cells = seen.select("a", F.col("b").alias("key"), cell.cast("int").alias("cell"))
    split = cut_lineage(split.join(cells, ["a", "key"], "left").withColumn("cell", F.coalesce("cell", F.lit(0))), "split")
    ends = split.groupBy("band", "cell").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
    ends = ends.groupBy("band").agg(F.collect_list(F.struct("cell", "x", "y")).alias("cells"))  # some few cells a band
    near = lambda c: F.filter("cells", lambda d: F.abs(d["cell"] - c) <= 1)
    undone = F.filter("cells", lambda c: F.array_min(F.transform(near(c["cell"]), lambda d: d["x"])) != F.array_max(F.transform(near(c["cell"]), lambda d: d["y"])))
    open_cells = ends.select("band", F.explode(F.transform(undone, lambda c: c["cell"])).alias("cell"))
    rest = cut_lineage(split.join(open_cells, ["band", "cell"], "left_semi").join(reps.select("key", "n", "sig"), "key"), "rest")

    def sized(rows: DataFrame, keys: DataFrame | None = None) -> DataFrame:
        rows = rows if keys is None else rows.join(keys, ["band", "key"])
        return rows.join(rows.groupBy("band").agg(F.count("*").alias("m"), F.sum("n").alias("words")), "band")

    named = cut_lineage(with_candidates(sized(rest), percent), "named")
    more = cut_lineage(forest(cut_lineage(sized(rest.drop("sig"), named), "loose"), bodies, percent), "forest")
    if more.isEmpty():
        return joined
    # Links between components join whole components: only these are walked again.
    for x in ("a", "b"):
        more = more.join(joined.select(F.col("node").alias(x), F.col("root").alias("_root")), x, "left").withColumn(x, F.coalesce("_root", x)).drop("_root")
    upper = cut_lineage(components(more).withColumnRenamed("root", "upper"), "components")
    moved = joined.join(upper.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("upper", "root").alias("root"))
    # A class that had no link before is its own root.
    return moved.union(upper.join(joined, "node", "left_anti").select("node", F.col("upper").alias("root")))


def _annotated(fn, *types):
    """``fn`` with its types as objects, as pandas UDFs want them."""
    fn.__annotations__ = dict(zip([*fn.__code__.co_varnames[: len(types) - 1], "return"], types))
    return fn


def clustered(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """Per row: id, row_key, n_shingles, root (binary; null without words), component_id."""
    signed = F.pandas_udf(_annotated(_signed, pd.Series, pd.DataFrame), SIGNED)(F.col(text_col))
    rows = cut_lineage(df.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"), signed.alias("s")).select("id", "row_key", "s.*"), "signatures")
    reps = cut_lineage(rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"), F.min("row_key").alias("row_key"), F.min("n").alias("n"), F.min("sig").alias("sig")), "classes")

    def bodies_of(keys: DataFrame) -> DataFrame:
        wanted = reps.join(keys, "key", "left_semi").select("key", "row_key")
        texts = df.select(row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("body"))
        return texts.join(wanted, "row_key").groupBy("key").agg(F.any_value("body").alias("body"))

    joined = grouped(reps, bodies_of, percent)
    rooted = reps.select("key", "id").join(joined.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    rooted = cut_lineage(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = cut_lineage(rooted.select("key", "root").join(least, "root"), "named")
    out = rows.select("id", "row_key", "key", F.col("n").alias("n_shingles")).join(named, "key", "left")
    return out.select(F.col("id").alias(id_col), "row_key", "n_shingles", "root", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """``df`` with one row of each component, that of the smallest id; rows without words stay."""
    seen = cut_lineage(clustered(df, id_col, text_col, percent), "clustered")
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "row_key")
    best = seen.filter("root IS NOT NULL").groupBy("root").agg(F.min(order)["row_key"].alias("winner")).select("winner")
    best = cut_lineage(best, "winners")
    (key,) = fresh(df, "row_key")
    keyed = df.withColumn(key, row_key(id_col, text_col))
    columns = [F.col(f"`{c}`") for c in df.columns]
    won = keyed.join(best, F.col(key) == F.col("winner"), "left_semi")
    if seen.join(best, F.col("row_key") == F.col("winner"), "left_semi").groupBy("row_key").count().filter("count > 1").limit(1).count():
        won = won.dropDuplicates([key])
    wordless = df.filter(F.trim(F.translate(F.coalesce(F.col(text_col), F.lit("")), "\t\n\v\f\r", "     ")) == "")
    return won.select(*columns).union(wordless)


def op7_circulant_minhash(spark, sf_dir: str) -> DataFrame:
    out = clustered(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


QUERIES = {"op7_circulant_minhash": op7_circulant_minhash}
ORACLES: dict[str, str] = {}
