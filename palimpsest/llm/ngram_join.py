"""Self-join of documents on the Jaccard similarity of their word n-gram sets.

Rare-first prefix filtering: in an order with the rare n-grams first, two sets that are similar
enough share one within their prefixes. Documents with equal sets are one node. Prefix n-grams that
no other set of a size that may link has are dropped once they are sorted; the rest is joined under a
length, a positional and a suffix filter. Nodes that share an n-gram first meet one leader each, so that a
large group of near copies becomes one component before the pairs between components, all of them,
are met; each pair is verified once, on its whole sets. Sets are made from the texts where they are
needed and kept only for the pairs of a round.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import bit_set, forget, slices, staged, texts_of
from palimpsest.llm.hashing import mix, span_hashes

WORDS = 5
PERCENT = 75  # similarity of 0.75 or more, in hundredths
HEAVY = 131_072  # frequent n-grams that come last in the order, at most; any order gives the same links
LOCAL = 3  # documents of one task that have an n-gram, for it to count as frequent there
HELD = 4_000_000  # n-grams that a task counts at a time
SLOTS = 1 << 23, 1 << 28  # bits of the filter of the texts whose sets are wanted, at least and at most
SPREAD = 64  # bits of it a text that is wanted; past the most it lets more through, never fewer
CELLS = 256  # cells of a set's profile for the suffix filter
PARITY = ("p0", "p1", "p2", "p3")
PLACE = ("left", "rest", "own", "end")
SMALL = 32  # nodes with a common n-gram whose pairs are all met in one round
ROUNDS = 2  # leader rounds; then all pairs of the larger groups are met, in bands of set size

#: A-Z to a-z, and each separator to a blank.
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t\n\x0b\x0c\r", bytes(range(97, 123)) + b" " * 5)
_BYTES = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a text; the whole sequence where it has fewer words."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_FOLD), np.uint8)
    blank = b == 32
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    if not len(begin):
        return np.empty(0, np.uint64)
    word = span_hashes(_BYTES[b], begin, end)
    size = min(words, len(word))
    out = np.zeros(len(word) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + word[k : len(word) - size + 1 + k])
    return np.unique(out)


def _name(s: np.ndarray) -> tuple[int, int]:
    """128 bits for a set."""
    h = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _profile(s: np.ndarray) -> bytes | None:
    """How many members fall in each cell of the hash space; none where one has more than a byte holds."""
    n = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=CELLS)
    return n.astype(np.uint8).tobytes() if n.max(initial=0) < 256 else None


def _parity(s: np.ndarray) -> list[int]:
    """Whether each of 256 cells has an odd number of members, in four words: sets differ in at least as many members as these bits do."""
    odd = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


class Frequent:
    """Counts n-grams over a task in bounded memory: what a full block has once is let go."""

    def __init__(self):
        self.parts, self.held = [], 0
        self.grams, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, s: np.ndarray) -> None:
        self.parts.append(s)
        self.held += len(s)
        if self.held >= HELD:
            self._fold()

    def _fold(self) -> None:
        new, n = np.unique(np.concatenate([np.empty(0, np.uint64), *self.parts]), return_counts=True)
        both, back = np.unique(np.concatenate((self.grams, new)), return_inverse=True)
        total = np.bincount(back, np.concatenate((self.counts, n)), len(both)).astype(np.int64)
        often = total > 1
        self.grams, self.counts, self.parts, self.held = both[often], total[often], [], 0

    def often(self) -> tuple[np.ndarray, np.ndarray]:
        self._fold()
        kept = self.counts >= LOCAL
        return self.grams[kept], self.counts[kept]


def described(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """kind 0: doc_id, key (as given), n, h1, h2 (names of the set), seen (hash of the text), profile and parity of each row.

    kind 1: n-grams (as h1) that many documents of a task have, and their count n.
    """
    names = ["kind", "doc_id", "key", "n", "h1", "h2", "seen", "profile", *PARITY]
    types = [*[pa.int64()] * 7, pa.binary(), *[pa.int64()] * 4]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent()
        for batch in slices(batches, 1):
            known: dict[str, tuple] = {}
            rows = []
            for doc_id, t, k, seen in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if t not in known:
                    s = shingles(t)
                    known[t] = (len(s), *_name(s), seen, _profile(s), *_parity(s)) if len(s) else (0, None, None, seen, *[None] * 5)
                    frequent.add(s)
                rows.append((0, doc_id, k, *known[t]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        gram, n = frequent.often()
        none = [pa.nulls(len(gram), t) for t in types]
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(gram), np.int64)), *none[1:3], pa.array(n), pa.array(gram.view(np.int64)), *none[5:]], names=names)

    key = F.lit(None).cast("long") if key is None else key
    given = docs.select("doc_id", "text", key.alias("key"), _seen())
    return given.mapInArrow(made, "kind long, doc_id long, key long, n long, h1 long, h2 long, seen long, profile binary, " + ", ".join(f"{c} long" for c in PARITY))


def _seen() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("seen")


class Order:
    """Rare n-grams by hash, then the frequent ones by their count."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        by = np.argsort(grams)
        self.grams, self.counts = grams[by], counts[by]

    def late(self, s: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros(len(s), bool)
        return self.grams[np.minimum(np.searchsorted(self.grams, s), len(self.grams) - 1)] == s

    def prefix(self, s: np.ndarray, percent: int) -> np.ndarray:
        if not len(s):
            return s
        length = len(s) - -(-percent * len(s) // 100) + 1
        if not len(self.grams):
            return s[:length]
        at = np.minimum(np.searchsorted(self.grams, s), len(self.grams) - 1)
        weight = np.where(self.grams[at] == s, self.counts[at], 0)
        return s[np.lexsort((s, weight))][:length]


def prefixes(docs: DataFrame, order: Order, percent: int) -> DataFrame:
    """gram, h1 and n (of the set), pos and late (a frequent one) of the n-grams in the prefix of each set, once a task."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, 0):
            names, sizes, found = [], [], [np.empty(0, np.uint64)]
            for t in dict.fromkeys(texts_of(batch.column(0))):
                s = shingles(t)
                h1 = _name(s)[0]
                if len(s) and h1 not in seen:
                    if len(seen) < 200_000:  # copies beyond are dropped later
                        seen.add(h1)
                    names.append(h1)
                    sizes.append(len(s))
                    found.append(order.prefix(s, percent))
            many = np.array([len(x) for x in found[1:]], np.int64)
            pos = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            grams = np.concatenate(found)
            columns = [grams.view(np.int64), np.repeat(np.array(names, np.int64), many), np.repeat(np.array(sizes, np.int32), many), pos.astype(np.int32), order.late(grams)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "h1", "n", "pos", "late"])

    return docs.select("text").mapInArrow(made, "gram long, h1 long, n int, pos int, late boolean")


def postings(found: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """gram, node, n, left, rest, own and end of the prefix n-grams that another prefix has too, of a set of a size that may link.

    left: how many n-grams of the set come after this one; rest: those of them that were kept or lie behind
    the prefix; own: n-grams of the prefix that were not kept; end: 31 bits of the order's place where the
    prefix ends. The n-grams are sorted by themselves, so what is dropped doesn't depend on how many there are.
    """
    group = Window.partitionBy("gram").orderBy("n", "h1")
    behind = (F.ceil(F.col("n") * percent / 100) - 1).cast("int")  # n-grams after the prefix
    last = F.col("pos") + behind + 1 == F.col("n")  # tells where the prefix ends, kept or not
    several = found.withColumns({"before": F.lag("h1").over(group), "after": F.lead("h1").over(group)})
    several = several.filter((F.col("before").isNotNull() | F.col("after").isNotNull() | last) & ~F.col("before").eqNullSafe(F.col("h1")))  # of copies one
    near = several.withColumns({"less": F.lag("n").over(group), "more": F.lead("n").over(group)})  # the next in size are the likeliest to link
    shared = _sizes_may_link(F.col("less"), F.col("n"), percent) | _sizes_may_link(F.col("n"), F.col("more"), percent)
    near = near.withColumn("kept", F.coalesce(shared, F.lit(False))).filter(F.col("kept") | last)
    own = Window.partitionBy("h1", "n")
    place = F.when(F.col("late"), (1 << 31) - 1).otherwise(F.shiftrightunsigned("gram", 33)).cast("int")
    each = {"before": F.row_number().over(own.orderBy("pos")), "many": F.count_if("kept").over(own), "end": F.max(F.when(last, place)).over(own)}
    kept = near.select("gram", "h1", "n", "pos", "kept", "late").withColumns(each).filter("kept")
    table = kept.join(nodes.select("h1", "node", F.col("n").cast("int").alias("n")), ["h1", "n"])
    left, rest, own = F.col("n") - F.col("pos") - 1, behind + F.col("many") - F.col("before"), F.col("n") - behind - F.col("many")
    return table.select("gram", "node", "n", left.alias("left"), rest.cast("int").alias("rest"), own.cast("int").alias("own"), "end")


def _test(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7) & 1).astype(bool)


def _overlap_needed(n: Column, m: Column, percent: int) -> Column:
    """Common n-grams that sets of n and m need: 100 * c >= percent * (n + m - c)."""
    return F.ceil((n + m) * percent / (100 + percent))


def _sizes_may_link(less: Column, more: Column, percent: int) -> Column:
    return 100 * less.cast("long") >= percent * more.cast("long")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Length and positional filter for two sets that share an n-gram.

    The first n-gram in the order that two sets share has all others after it in both. So a pair that
    links passes at its first common n-gram; at later ones it need not. Of the set whose prefix ends
    first, an n-gram that was not kept is common with no set that may link: the other's prefix would have it. Of the
    other set it may be, since it may lie behind the first one's prefix; so that one's ``rest`` bounds nothing.
    """
    an, bn = F.col(f"{a}.n"), F.col(f"{b}.n")
    first = F.when(F.col(f"{a}.end") < F.col(f"{b}.end"), F.col(f"{a}.rest")).when(F.col(f"{a}.end") > F.col(f"{b}.end"), F.col(f"{b}.rest")).otherwise(F.greatest(f"{a}.rest", f"{b}.rest"))
    position = F.least(first, f"{a}.left", f"{b}.left") + 1 >= _overlap_needed(an, bn, percent)
    return _sizes_may_link(F.least(an, bn), F.greatest(an, bn), percent) & position & (F.col(f"{a}.comp") != F.col(f"{b}.comp"))


def led(table: DataFrame, percent: int, seed: int) -> DataFrame:
    """(a, b): each node with the leader of every group that it is in, if they may link.

    The first leader is the node with the fewest n-grams of its own, since that is in the middle of a group of near copies.
    """
    rank = F.xxhash64("node", F.lit(seed))
    if seed == 0:
        rank = F.col("own").cast("long") * (1 << 32) + F.pmod(rank, F.lit(1 << 32))
    chief = table.groupBy("gram").agg(*(F.min_by(c, rank).alias(c) for c in ("node", "n", *PLACE, "comp"))).alias("a")
    pairs = table.alias("b").join(chief, F.col("a.gram") == F.col("b.gram")).filter((F.col("a.node") != F.col("b.node")) & _may_link("a", "b", percent))
    return pairs.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def met(table: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs that share an n-gram and may link; joined on the size of the sets too, which splits groups, with the parities as a filter."""
    table = table.join(nodes.select("node", *PARITY), "node")
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int")
    a = table.withColumn("band", band).alias("a")
    b = table.withColumn("band", F.explode(F.array(band - 1, band, band + 1))).alias("b")
    apart = sum((F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}"))) for c in PARITY), F.lit(0))
    near = apart <= F.col("a.n") + F.col("b.n") - 2 * _overlap_needed(F.col("a.n"), F.col("b.n"), percent)
    on = [F.col("a.gram") == F.col("b.gram"), F.col("a.band") == F.col("b.band"), F.col("a.node") < F.col("b.node")]
    found = a.join(b, [*on, _may_link("a", "b", percent), near])
    return found.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, comp (the least node reachable) of all nodes in ``links`` (a, b): labels spread along links and jump."""
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        joined = labels.join(near, labels.node == near.a).select("node", "comp", F.least("comp", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("comp").alias("far"))
        moved = staged(joined.join(jump, "new", "left").select("node", "comp", F.least("new", F.coalesce("far", "new")).alias("new")), "labels")
        changed = moved.filter("comp <> new").limit(1).count()
        forget(labels)
        labels = moved.select("node", F.col("new").alias("comp"))
        if not changed:
            forget(both)
            return labels


def joined_up(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """``comp`` (node, comp) after more links: the links between components make components of components."""
    if comp is None:
        return components(links)
    ends = links
    for c in ("a", "b"):
        own = comp.select(F.col("node").alias(c), F.col("comp").alias("c"))
        ends = ends.join(own, c, "left").withColumn(c, F.coalesce("c", c)).drop("c")
    new = components(ends.filter("a <> b"))
    moved = comp.join(new.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    out = staged(moved.union(new.join(comp, "node", "left_anti").select("node", "comp")), "components")
    forget(comp, new)
    return out


def profiled(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The suffix filter: pairs whose profiles allow enough common n-grams. No cell can have more in common than its smaller count."""
    own = nodes.select("node", "n", "profile")
    p = pairs.join(own.withColumnsRenamed({"node": "a", "n": "an", "profile": "ap"}), "a").join(own.withColumnsRenamed({"node": "b", "n": "bn", "profile": "bp"}), "b")

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.ones(batch.num_rows, bool)
            an, bn = (batch.column(k).to_numpy() for k in (2, 3))
            ap, bp = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            at = [k for k in range(batch.num_rows) if ap[k] is not None and bp[k] is not None]
            if at:
                x, y = (np.frombuffer(b"".join(v[k] for k in at), np.uint8).reshape(-1, CELLS) for v in (ap, bp))
                out[at] = np.minimum(x, y).sum(1, dtype=np.int64) * (100 + percent) >= percent * (an[at] + bn[at])
            yield batch.select([0, 1]).filter(pa.array(out))

    return p.select("a", "b", "an", "bn", "ap", "bp").mapInArrow(passed, "a long, b long")


def slots_for(wanted: int) -> int:
    """Bits of the filter for so many texts, so that it lets through of the others one in SPREAD at most."""
    return min(max(SLOTS[0], 1 << (SPREAD * wanted - 1).bit_length()), SLOTS[1])


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """slot, h1, h2 and grams of the texts that ``wanted`` (seen) names, once a task; a bitmap picks the texts."""
    size = slots_for(wanted.count())
    only = bit_set(wanted.select(F.pmod("seen", F.lit(size)).alias("bit")), size)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, known = TaskContext.get().partitionId() << 33, set()
        for batch in batches:
            picked = batch.filter(pa.array(_test(only, batch.column(1).to_numpy() % size)))
            for part in slices(iter([picked]), 0):
                rows = []
                for t, seen in zip(texts_of(part.column(0)), part.column(1).to_pylist()):
                    if seen not in known:
                        if len(known) < 200_000:
                            known.add(seen)
                        s = shingles(t)
                        rows.append((slot, *_name(s), s.tobytes()))
                        slot += 1
                columns = zip(*rows) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*[pa.int64()] * 3, pa.binary()])], names=["slot", "h1", "h2", "grams"])

    return docs.select("text", _seen()).mapInArrow(made, "slot long, h1 long, h2 long, grams binary")


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link, staged; what was gathered for it is deleted."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = staged(nodes.select("node", "h1", "h2", "seen").join(ends, "node", "left_semi"), "wanted")
    sets = staged(sets_of(docs, wanted), "sets", batch_rows=2_000)
    # One stored set stands for a node.
    slots = staged(sets.select("h1", "h2", "slot").join(wanted, ["h1", "h2"]).groupBy("node").agg(F.min("slot").alias("slot")), "slots")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                x, y = (x, y) if len(x) < len(y) else (y, x)
                common = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
                out.append(common * (100 + percent) >= percent * (len(x) + len(y)))
            yield batch.select([0, 1]).filter(pa.array(out, pa.bool_()))

    p = pairs
    for end in ("a", "b"):
        p = p.join(slots.withColumnsRenamed({"node": end, "slot": f"slot_{end}"}), end)
    for end in ("a", "b"):
        p = p.join(sets.select(F.col("slot").alias(f"slot_{end}"), F.col("grams").alias(f"grams_{end}")), f"slot_{end}")
    links = staged(p.select("a", "b", "grams_a", "grams_b").mapInArrow(linked, "a long, b long"), "links", batch_rows=1_000)
    forget(wanted, sets, slots)
    return links


def link_components(docs: DataFrame, percent: int = PERCENT, key: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, key, n, node; components: node, comp) without the nodes that have no link, both staged."""
    found = staged(described(docs, key), "described")
    heavy = found.filter("kind = 1").groupBy("h1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h1").limit(HEAVY).toArrow()  # bounded
    order = Order(heavy.column(0).to_numpy().view(np.uint64), heavy.column(1).to_numpy())
    rows = found.filter("kind = 0").select("doc_id", "key", "n", "h1", "h2")
    # A node is a set by its 128 bits; its number is given once, when the table is written.
    nodes = found.filter("kind = 0 and n > 0").groupBy("h1", "h2", "n").agg(F.min("seen").alias("seen"), *(F.any_value(c).alias(c) for c in ("profile", *PARITY)))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    table = staged(postings(prefixes(docs, order, percent), nodes, percent), "postings")

    comp = tried = None
    for k in range(ROUNDS + 1):
        if comp is None:
            pairs = led(table.withColumn("comp", F.col("node")), percent, 0)
        else:
            left = table.join(comp, "node", "left").select("gram", "node", "n", *PLACE, F.coalesce("comp", "node").alias("comp"))
            groups = left.groupBy("gram").agg(F.count("*").alias("members"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            groups = groups.filter("lo <> hi and members > 2")  # a group of two is settled by the first round
            left = staged(left.join(groups.select("gram", "members"), "gram"), "open")
            forget(table)
            last = F.col("members") <= SMALL if k < ROUNDS else F.lit(True)
            small, table = left.filter(last), left.filter(~last)
            pairs = met(small, nodes, percent).union(led(table, percent, k)).distinct()
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
            table = table.select("gram", "node", "n", *PLACE)
        pairs = staged(profiled(pairs, nodes, percent), "pairs")
        links = verified(docs, nodes, pairs, percent)
        tried = pairs if tried is None else tried.union(pairs)
        comp = joined_up(comp, links)
        forget(links)
        if k and not table.limit(1).count():
            break
    forget(table)
    rows = rows.join(nodes.select("h1", "h2", "node"), ["h1", "h2"], "left").select("doc_id", "key", "n", "node")
    return rows, comp


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by links) of every row.

    Two documents link when 100 * |common| >= percent * |union| of their n-gram sets. Fewer than WORDS
    words are one n-gram; null, empty and blank texts have none, link with nothing and are their own
    component. Equal texts link; repeated rows are rows. Rows without an id keep a null component unless
    they link with one. Extra columns are ignored; an empty table gives no rows. N-grams count as equal
    by 64 bits of hash, sets by 128.
    """
    rows, comp = link_components(docs, percent)
    known = staged(rows.join(comp, "node", "left").select("doc_id", "n", F.coalesce("comp", "node").alias("comp")), "known")
    least = known.filter("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return known.join(least, "comp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near duplicates, with the columns of ``docs``.

    It is the row with the least doc_id, nulls last, and of these the one with the least text hash. Rows
    that link with nothing stay, with or without an id or words. Rows with the same id and the same text
    are one row; which of them stays is open where other columns differ. Texts of one id are told apart
    by 64-bit hashes.
    """
    rows, comp = link_components(docs, percent, F.xxhash64("text"))
    group = F.coalesce("comp", "node")  # null without words: such a row is its own group
    alone = [F.when(group.isNull(), F.col(c)).alias(f"alone_{c}") for c in ("doc_id", "key")]
    rows = rows.join(comp, "node", "left").select("doc_id", "key", group.alias("group"), *alone)
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("x")
    stay = rows.groupBy("group", "alone_doc_id", "alone_key").agg(least).select(F.col("x.doc_id").alias("__id"), F.col("x.key").alias("__stay"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own"), F.xxhash64("text").alias("key"))
    kept = keyed.join(stay, keyed["own"].eqNullSafe(stay["__id"]) & (keyed["key"] == stay["__stay"]), "left_semi")
    return kept.dropDuplicates(["own", "key"]).select(*(F.col("row")[c].alias(c) for c in docs.columns))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS grams FROM w),
e AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.gram = y.gram AND x.doc_id <> y.doc_id
      GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a)
SELECT s.doc_id, len(grams)::BIGINT AS n_shingles, min(r.b) AS component_id FROM s JOIN r ON r.a = s.doc_id GROUP BY ALL
"""
