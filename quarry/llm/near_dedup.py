"""Near-duplicates by one-permutation MinHash with densification, banded buckets and star-shaped candidates.

A text's set is its distinct word shingles, as 64-bit hashes. One hash of each shingle gives its bin and its
value; a bin keeps its least value, and an empty bin takes that of the occupied bin which comes first in a
random order of its own (densification). Bins are cut into bands; texts that agree on a band share a bucket.

Texts with equal sets are one class, so that copies never meet in pairs. Within a bucket each class is
paired with the bucket's first and last class alone: a bucket of m classes gives fewer than 2 m pairs. Pairs
whose sizes rule the similarity out are dropped, which loses nothing; the others are confirmed on full sets.
What is still apart in a bucket then is met in full: every member outside the
bucket's largest group with every member of another group, in tiles, each pair in the first bucket that it
shares alone, so that no possible pair of a bucket stays untested. A tile compares bit maps of the sets: bits
that differ are no more than shingles that differ, so that a pair whose bits differ too much can't be linked and
goes no further. The others are confirmed, in turns if they are many: first one of each two groups, then four times
as many a turn, without the pairs that a turn has linked. With 32 bands of 5 bins, two texts of similarity 0.8 share no bucket with
a probability of 3 in a million, and about ten buckets on average; this is the only loss of the whole method.

Only the texts of classes that share a bucket are read again, once, for their sets; a bit table of bounded size
keeps others out of the shuffle.

Defined cases. Null text counts as empty: no shingles, linked with nothing. Rows without id are linked with
nothing, and rows that share an id are one node. Equal sets are linked whatever their number. Empty input:
empty output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .exact_dedup import MAX_BITS, table_bits
from .shared import discard, documents, heavy_limit, map_arrow, salted_join, stored, weighted_join

BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
#: Bytes of text hashed at once.
BLOCK = 1 << 20
#: Rows on either side of a tile, on average. Pairs confirmed at once: for each class, and at least.
TILE, SLICE, LEAST = 2048, 0.5, 20_000
#: Bytes of bit maps that a tile compares at once.
COMPARED = 1 << 21

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True
_RANKS = np.random.default_rng(7).random((BINS, BINS))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, 4096), _powers(pow(_BASE, -1, 1 << 64), 4096)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in lower-cased bytes, and the places where they begin."""
    global _UP, _DOWN
    if len(data) > len(_UP):
        size = 1 << int(len(data)).bit_length()
        _UP, _DOWN = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    inside = np.concatenate([[False], ~_WHITE[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[data] * _UP[: len(data)], dtype=np.uint64)])
    return _mix((sums[end] - sums[begin]) * _DOWN[np.minimum(begin, len(_DOWN) - 1)] + (end - begin).astype(np.uint64)), begin


def _pieces(raw: bytes) -> Iterator[bytes]:
    """`raw` cut at white space into blocks of about BLOCK bytes."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + BLOCK)
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield raw[at:end]
        at = end


def _sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        raw = (text or "").encode("utf-8", "replace")
        if group and size + len(raw) > BLOCK:
            yield from _sets_of(group, k)
            group, size = [], 0
        group.append(raw)
        size += len(raw) + 1
    if group:
        yield from _sets_of(group, k)


def _sets_of(group: list[bytes], k: int) -> Iterator[np.ndarray]:
    if len(group) == 1 and len(group[0]) > BLOCK:
        hashes = np.concatenate([_word_hashes(_LOWER[np.frombuffer(p, np.uint8)])[0] for p in _pieces(group[0])])
        counts = [len(hashes)]
    else:
        lengths = np.array([len(raw) + 1 for raw in group])
        hashes, begin = _word_hashes(_LOWER[np.frombuffer(b" ".join(group) + b" ", np.uint8)])
        counts = np.diff(np.searchsorted(begin, np.concatenate([[0], np.cumsum(lengths)])))
    at = 0
    for n in counts:
        own = hashes[at : at + n]
        at += n
        width = min(k, n)
        if not width:
            yield own
            continue
        made = own[: n - width + 1].copy()
        for j in range(1, width):
            made = _mix(made * _U(0xD6E8FEB86659FD93) + own[j : n - width + 1 + j])
        yield np.unique(made)


def signature(hashes: np.ndarray) -> np.ndarray:
    """One value for each bin, densified. `hashes` holds one at least."""
    out = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    bins = (hashes % _U(BINS)).astype(np.int64)
    np.minimum.at(out, bins, hashes // _U(BINS))
    taken = np.zeros(BINS, bool)
    taken[bins] = True
    if not taken.all():
        full, empty = np.flatnonzero(taken), np.flatnonzero(~taken)
        out[empty] = out[full[_RANKS[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def bands(hashes: np.ndarray) -> np.ndarray:
    rows = signature(hashes).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = _mix(key * _U(0xA24BAED4963EE407) + rows[:, j])
    return key.view(np.int64)


def bit_map(hashes: np.ndarray) -> bytes:
    """A bit for each hash's place, in a power of two of bits, eight for a hash at least."""
    width = max(64, 1 << (8 * len(hashes) - 1).bit_length()) if len(hashes) else 64
    bits = np.zeros(width, bool)
    bits[(hashes & _U(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_link(left: list[bytes], right: list[bytes], i: np.ndarray, j: np.ndarray, n1: np.ndarray, n2: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs (left[i], right[j]) of sizes n1 and n2 can be linked: bits that differ are shingles that differ. The wider map is folded first."""
    out = np.zeros(len(i), bool)
    wide1, wide2 = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    least = np.minimum(wide1[i], wide2[j])
    for width in np.unique(least):
        at = np.flatnonzero(least == width)
        maps = []
        for bits, wide, used in ((left, wide1, i[at]), (right, wide2, j[at])):
            rows, place = np.unique(used, return_inverse=True)
            folded = np.stack([np.bitwise_or.reduce(np.frombuffer(bits[r], np.uint64).reshape(wide[r] // width, -1), axis=0) for r in rows])
            maps.append((folded, place))
        (x, px), (y, py) = maps
        step = max(1, COMPARED // int(width))
        for k in range(0, len(at), step):
            own = at[k : k + step]
            differ = np.bitwise_count(x[px[k : k + step]] ^ y[py[k : k + step]]).sum(1, dtype=np.int64)
            both = n1[own] + n2[own]
            out[own] = 100 * (both - differ) >= percent * (both + differ)
    return out


def _tile(few, others, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i of few, j of others) that a tile leaves to be confirmed. Both: dicts of arrays; bands as a matrix."""
    found = [], []
    bucket = few["bucket"][0]
    band = int(np.flatnonzero(few["bands"][0] == bucket)[0])
    for at in range(0, len(few["n"]), 256):
        n1, g1, x = few["n"][at : at + 256, None], few["group"][at : at + 256, None], few["rep"][at : at + 256, None]
        n2 = others["n"][None]
        open_ = (n1 * 100 >= percent * n2) & (n2 * 100 >= percent * n1) & (g1 != others["group"][None]) & (~others["few"][None] | (x < others["rep"][None]))
        i, j = np.nonzero(open_)
        if band and len(i):  # each pair in the first bucket that it shares
            first = np.ones(len(i), bool)
            for k in range(0, len(i), 1 << 13):
                own = slice(k, k + (1 << 13))
                first[own] = ~(few["bands"][at + i[own], :band] == others["bands"][j[own], :band]).any(1)
            i, j = i[first], j[first]
        if len(i):
            i = i + at
            may = may_link(few["bits"], others["bits"], i, j, few["n"][i], others["n"][j], percent)
            found[0].append(i[may])
            found[1].append(j[may])
    none = np.zeros(0, np.int64)
    return np.concatenate([*found[0], none]), np.concatenate([*found[1], none])


def _tiles(rows: DataFrame, id_type: T.DataType, percent: int) -> DataFrame:
    """(a, b) of possible pairs. rows: bucket, i, j, side (0: few, 1: others), few, rep, group, n, bands, bits; a tile's rows come one after the other."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(id_type)

    def compare(table):
        import pyarrow as pa

        sides = []
        for side in (0, 1):
            own = table.filter(pa.compute.equal(table.column("side"), side))
            if not own.num_rows:
                return None
            ids = [own.column(c).combine_chunks() for c in ("rep", "group")]
            ids = [x.to_numpy(zero_copy_only=False) for x in ids]
            sides.append({
                "bucket": own.column("bucket").to_numpy(), "rep": ids[0], "group": ids[1], "n": own.column("n").to_numpy().astype(np.int64), "few": own.column("few").to_numpy().astype(bool),
                "bands": own.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS), "bits": own.column("bits").to_pylist(),
            })
        i, j = _tile(*sides, percent)
        if not len(i):
            return None
        x, y = sides[0]["rep"][i], sides[1]["rep"][j]
        low = x < y
        return pa.RecordBatch.from_arrays([pa.array(np.where(low, x, y), kind), pa.array(np.where(low, y, x), kind)], names=["a", "b"])

    def run(batches):
        import pyarrow as pa

        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([*held, batch])
            key = np.stack([whole.column(c).to_numpy().astype(np.int64) for c in ("bucket", "i", "j")])
            edge = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1).tolist()]
            for begin, end in zip(edge, edge[1:]):
                made = compare(whole.slice(begin, end - begin))
                if made:
                    yield made
            held = whole.slice(edge[-1]).to_batches()
        if held:
            made = compare(pa.Table.from_batches(held))
            if made:
                yield made

    name = id_type.simpleString()
    return map_arrow(rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"), run, f"a {name}, b {name}")


def _arrow(df: DataFrame, id_type: T.DataType, k: int, full: bool) -> DataFrame:
    """df: id, text. Gives id, n, the set's key and bands and, if `full`, the set and its bit map."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(id_type)

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = list(_sets(batch.column(1).to_pylist(), k))
                ids, n = batch.column(0).cast(kind), pa.array([len(s) for s in sets], pa.int32())
                keys = pa.array([hashlib.md5(s.tobytes()).hexdigest() if len(s) else None for s in sets], pa.string())
                marks = pa.array([bands(s).tolist() if len(s) else None for s in sets], pa.list_(pa.int64()))
                columns, names = [ids, n, keys, marks], ["id", "n", "key", "bands"]
                if full:
                    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                    flat = pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))
                    columns += [pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array([bit_map(s) for s in sets], pa.binary())]
                    names += ["shingles", "bits"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    name = id_type.simpleString()
    return map_arrow(df, run, f"id {name}, n int, key string, bands array<long>" + ", shingles array<long>, bits binary" * full)


def _only(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of `df` (id, ...) whose id is in `ids`. A bit table of bounded size keeps most others from the join's shuffle."""
    bits = table_bits(ids.count(), MAX_BITS)
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = ids.select(place.alias("bit")).groupBy(F.shiftright("bit", 6).alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("__mask"))
    near = df.withColumn("__bit", place).join(F.broadcast(stored(words, "near-bits")), F.shiftright("__bit", 6) == F.col("__word"))
    near = near.where("(shiftright(__mask, int(__bit & 63)) & 1L) = 1").drop("__bit", "__word", "__mask")
    return near.join(ids, "id", "left_semi")


def _centres(rows: DataFrame) -> DataFrame:
    """For each bucket of several classes (bucket, rep, n) their number m, and the first and the last."""
    return rows.groupBy("bucket").agg(F.count("*").alias("m"), F.min(F.struct("rep", "n")).alias("lo"), F.max(F.struct("rep", "n")).alias("hi")).where("m > 1")


def _pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b) of each member with its bucket's centres, if sizes allow a link."""
    met = members.select("rep", "n", F.explode(F.array("lo", "hi")).alias("c"))
    possible = (F.col("n") * 100 >= percent * F.col("c.n")) & (F.col("c.n") * 100 >= percent * F.col("n"))
    return met.where(possible).select(F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b")).where("a <> b").distinct()


def _apart(rows: DataFrame, sets: DataFrame, id_type: T.DataType, percent: int, limit: int) -> DataFrame:
    """(a, b) of members of a bucket (bucket, rep, n, group) in different groups that can be linked. Buckets of up to three members have met their centres. sets: id, bands, bits."""
    groups = rows.groupBy("bucket", "group").agg(F.count("*").alias("c"))
    split = groups.groupBy("bucket").agg(F.sum("c").alias("m"), F.count("*").alias("groups"), F.max(F.struct("c", "group")).alias("top")).where("m > 3 and groups > 1")
    split = stored(split.select("bucket", "m", F.col("top.c").alias("c"), F.col("top.group").alias("top")), "near-split")
    tiles = lambda n: F.ceil(n / TILE).cast("int")
    own = weighted_join(rows, "bucket", split, "m", limit).withColumn("__all", tiles(F.col("m"))).withColumn("__few", tiles(F.col("m") - F.col("c")))
    own = own.withColumn("few", F.col("group") != F.col("top")).join(sets.select(F.col("id").alias("rep"), "bands", "bits"), "rep").where(F.array_contains("bands", F.col("bucket")))
    place = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    kept = ("few", "rep", "group", "n", "bands", "bits")
    few = own.where("few").select("bucket", place("__few").alias("i"), F.explode(F.expr("sequence(0, __all - 1)")).alias("j"), F.lit(0).alias("side"), *kept)
    others = own.select("bucket", F.explode(F.expr("sequence(0, __few - 1)")).alias("i"), place("__all").alias("j"), F.lit(1).alias("side"), *kept)
    return _tiles(few.unionByName(others), id_type, percent)


def _ungrouped(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose components g1 and g2 differ."""
    ends = pairs.select("a", "b")
    for end, name in (("a", "__g1"), ("b", "__g2")):
        ends = ends.join(labels.select(F.col("node").alias(end), F.col("component").alias(name)), end, "left").withColumn(name, F.coalesce(name, end))
    return ends.where("__g1 <> __g2").select("a", "b", F.least("__g1", "__g2").alias("g1"), F.greatest("__g1", "__g2").alias("g2"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of which the sets' intersection is `percent` of their union or more. sets: id, n, shingles. A class that is in very many pairs is no task of its own."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("__n1"), F.col("shingles").alias("__s1"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("__n2"), F.col("shingles").alias("__s2"))
    limit = heavy_limit(pairs.count())
    both = salted_join(salted_join(pairs.select("a", "b"), "a", left, limit), "b", right, limit).withColumn("__common", F.size(F.array_intersect("__s1", "__s2")))
    return stored(both.where(F.col("__common") * 100 >= percent * (F.col("__n1") + F.col("__n2") - F.col("__common"))).select("a", "b"), "near-links")


def find_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """A row for each row of `df`: id, n_shingles, component_id (the smallest id that links reach), kept."""
    id_type = df.schema[id_col].dataType
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table = stored(_arrow(docs, id_type, words, False), "near-table")
    usable = table.where("n > 0 and id is not null")
    classes = stored(usable.groupBy("key").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "near-classes")
    places = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    centres = stored(_centres(places), "near-centres")
    limit = heavy_limit(BANDS * classes.count())
    members = stored(weighted_join(places, "bucket", centres, "m", limit), "near-members")
    ids = stored(members.select(F.col("rep").alias("id")).distinct(), "near-ids")
    sets = stored(_arrow(_only(docs, ids), id_type, words, True).dropDuplicates(["id", "key"]), "near-sets")
    first = stored(_pairs(members, percent), "near-pairs")
    links = _confirm(first, sets, percent)
    labels = stored(components(links), "near-labels")
    grouped = lambda: members.select("bucket", "rep", "n").join(labels, F.col("rep") == F.col("node"), "left").select("bucket", "rep", "n", F.coalesce("component", "rep").alias("group"))
    joined = lambda more: stored(components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "near-labels")
    left = stored(grouped(), "near-grouped")
    rest = stored(_apart(left, sets, id_type, percent, limit).join(first, ["a", "b"], "left_anti"), "near-rest")
    discard(centres, members, left, first, links, ids)
    once, quota, turn = max(LEAST, int(SLICE * classes.count())), 1, 0
    while True:
        turn += 1
        open_, mark = stored(_ungrouped(rest, labels), "near-open"), F.xxhash64("a", "b", F.lit(turn))
        discard(rest)
        n = open_.count()
        if n > once:
            few = open_.groupBy("g1", "g2", F.pmod(mark, F.lit(quota)).alias("q")).agg(F.min_by("a", mark).alias("a"), F.min_by("b", mark).alias("b"))
            picked = stored(few.select("a", "b"), "near-picked")
            n = picked.count()
        else:  # no more than a turn confirms: all of them
            picked = open_
        if not n:
            break
        slices = -(-n // once)
        now = picked.where(F.pmod(F.xxhash64("b", "a", F.lit(turn)), F.lit(slices)) == 0)
        more = _confirm(now, sets, percent)
        rest = stored(open_.select("a", "b").join(now, ["a", "b"], "left_anti"), "near-rest")
        if not more.isEmpty():
            labels = joined(more)
        discard(more, *({picked, open_}))
        quota *= 4 if slices == 1 else 1
    discard(open_, sets)
    of_class = classes.select("key", "rep").join(labels, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("component", "rep").alias("component"))
    found = usable.select("id", "n", "key").join(of_class, "key").select("id", "n", "component")
    rest = table.where("not (n > 0 and id is not null)").select("id", "n", F.col("id").alias("component"))
    return found.unionByName(rest).select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept")
    )


def drop_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `df` that stay: of each component those with its smallest id. Only rows that go are joined by; their ids pass a bit table of bounded size first."""
    gone = stored(find_near(df, id_col, text_col, words, percent).where("not kept").select(F.col(id_col).alias("__gone")).distinct(), "near-gone")
    bits = table_bits(gone.count(), MAX_BITS)
    place = F.pmod(F.xxhash64(F.col(id_col)), F.lit(bits))
    words_ = gone.select(F.pmod(F.xxhash64("__gone"), F.lit(bits)).alias("bit")).groupBy(F.shiftright("bit", 6).alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("__mask"))
    marked = df.withColumn("__bit", place).join(F.broadcast(stored(words_, "near-bits")), F.shiftright("__bit", 6) == F.col("__word"), "left")
    marked = marked.withColumn("__maybe", F.expr("coalesce(shiftright(__mask, int(__bit & 63)) & 1L, 0L) = 1"))
    sure = marked.where("not __maybe").select(*df.columns)
    left = marked.where("__maybe").select(*df.columns)
    return sure.unionByName(left.join(gone, F.col(id_col) == F.col("__gone"), "left_anti"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_near(documents(spark, sf_dir), words=2, percent=80)


QUERIES = {"op7_near_dedup": op7_near_dedup}
SQL: dict[str, str] = {}
