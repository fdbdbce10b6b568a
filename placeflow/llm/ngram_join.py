"""Near-duplicate documents: a Jaccard self-join of n-gram sets, with a prefix tree in each group.

A document's set holds 64-bit hashes of its n-word shingles. All sets are put in one global order: rare
shingles by hash, then the frequent ones by count. Two sets that reach the threshold share at least l of their
first `n - ceil(t n) + l` shingles (the prefix), whatever l is; l grows with the set here, so that a set with less
than l prefix shingles that any other set has, such as a text with a common passage, is left out at once. Each
prefix shingle names the least digest among the sets that hold it, its pivot; a set joins the groups of its
shingles' pivots, so any two sets that share a prefix shingle meet in a group, without a row for each pair.
Pivots of the frequent shingles (at most FREQUENT) are combined before the shuffle and broadcast. What is not
frequent has fewer holders than one in FREQUENT of all prefix shingles, or fewer than BATCH_LEAST in each slice.

Of its groups a set leaves those in which it has the fewest shingles, up to (l - 1) / 2 shingles in all, l being
the least that holds for any partner. Two sets that link share l prefix shingles or more, and both together left
fewer, so they still meet. So chance meetings in a large corpus don't add groups.

Before texts are sent to groups, short signatures are: bits (SIGNATURE, more for large sets), each the parity of the
number of shingles that fall on it; a longer one folds to a shorter. Two sets differ in at least as many shingles as
their signatures in bits, so a set whose signature is too far from all others it would meet, or whose size is, has
no link there, and its text isn't sent.

In a group, the ordered sets are stored in a trie. A set walks the trie once: all sets below a node share
the overlap up to that node, and a subtree is left as soon as the overlap and the lengths that remain can't
reach the threshold. Only links that connect are kept: sets already linked to the group's first set need
no walk of their own, as every other set is compared with all.

Copies are one set (by digest). Groups larger than a block are dealt to blocks that all hold one hub;
after that round, sets not connected to the hub meet every block, first by signature. No candidate is dropped.

Null and empty texts, and texts without words, have empty sets, which link with nothing. Texts of fewer words
than n are one shingle. Repeated rows are copies. A very long text is a slice of its own, its shingles some 50 bytes
for each word. Other columns are ignored, or carried if they are named; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeflow.llm._common import give_back, mix, parts, raw, separators, word_hashes, word_spans
from placeflow.operators.components import connected_components
from placeflow.scratch import discard, save

#: A block of a group: at most so many sets, and about so many shingles.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1_000_000
#: Shingles ordered last because they are frequent: at most so many, each in this many documents of a batch at least.
FREQUENT, BATCH_LEAST = 65_536, 3
SIGNATURE = 1024
#: Sets of more shingles than these have signatures 4 and 16 times as long.
LARGER = (1_000, 5_000)
#: Rows of three numbers that may be broadcast (24 MB).
BROADCAST_ROWS = 1_000_000
_INSIDE = separators()
_U = np.uint64
_FACTORS = mix(np.arange(11, 43, dtype=np.uint64)) | _U(1)


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    data, offsets = raw(column)
    starts, ends, first = word_spans(data, offsets, _INSIDE)
    words = word_hashes(data, starts, ends)
    out = []
    with np.errstate(over="ignore"):
        full = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for k in range(n):
            full += words[k : k + len(full)] * _FACTORS[k]
        full = mix(full)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if hi - lo >= n:
                out.append(np.unique(full[lo : hi - n + 1]))
            elif hi > lo:
                out.append(mix((words[lo:hi] * _FACTORS[: hi - lo]).sum(keepdims=True) + _FACTORS[-1] * _U(hi - lo)))
            else:
                out.append(full[:0])
    return out


def digest(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


def signature(tokens: np.ndarray) -> bytes:
    """The parity of the number of tokens on each bit."""
    bits = SIGNATURE << 2 * sum(len(tokens) > n for n in LARGER)
    counts = np.bincount((tokens & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def with_partner(signatures: list[bytes], sizes: np.ndarray, percent: int, asking: np.ndarray | None = None, digests: np.ndarray | None = None) -> np.ndarray:
    """Whether some other set may reach the threshold, by sizes and signatures; only pairs with an asking set count, if these are given, and a set's own digest doesn't."""
    own = np.array([len(s) for s in signatures])
    # By length: the sets whose signature has at least this length, with these folded to it.
    folded = {}
    for length in np.unique(own).tolist():
        at = np.flatnonzero(own >= length)
        rows = [np.bitwise_xor.reduce(np.frombuffer(signatures[i], np.uint64).reshape(-1, length // 8)) for i in at]
        folded[length] = (at, np.stack(rows), np.searchsorted(at, np.arange(len(own) + 1)))
    out = np.zeros(len(sizes), bool)
    for i in range(len(sizes)) if asking is None else np.flatnonzero(asking):
        if out[i] and asking is None:
            continue
        for length, (at, rows, place) in folded.items():
            if length > own[i]:
                break
            # Shorter signatures meet this one folded to theirs; all others meet it at its own length.
            k = np.arange(len(at)) if length == own[i] else np.flatnonzero(own[at] == length)
            other, size = at[k], sizes[at[k]]
            # At similarity p / 100 two sets differ in at most (100 - p) / (100 + p) of both sizes' sum.
            ok = np.bitwise_count(rows[k] ^ rows[place[i]]).sum(1, dtype=np.int64) * (100 + percent) <= (100 - percent) * (size + sizes[i])
            ok &= (100 * np.minimum(size, sizes[i]) >= percent * np.maximum(size, sizes[i])) & (other != i)
            if digests is not None:
                ok &= digests[other] != digests[i]
            if ok.any():
                out[i] = True
                out[other[ok]] = True
    return out


def prefix_size(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1


def extra(n: int, percent: int) -> int:
    """l - 1 for sets of n shingles. It doesn't shrink as n grows, so the smaller of two sets has the l that holds for both."""
    return prefix_size(n, percent) // 2


def _frequent(n: int):
    def run(batches):
        for batch in batches:
            for part in parts(batch, most=32 << 20):
                found = [s for p in parts(part) for s in shingle_sets(p.column("text"), n)]
                tokens = np.concatenate(found)
                del found
                tokens.sort()
                first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))) if len(tokens) else np.zeros(0, np.int64)
                counts = np.diff(np.append(first, len(tokens)))
                often = counts >= BATCH_LEAST
                yield pa.RecordBatch.from_arrays([pa.array(tokens[first[often]].view(np.int64)), pa.array(counts[often].astype(np.int64))], ["token", "n"])
                del tokens, first, counts, often
            give_back()

    return run


def _prefixes(n: int, percent: int, frequent, more: tuple[str, ...]):
    def run(batches):
        tokens, places = frequent.value
        for batch in batches:
            for part in parts(batch):
                rows = []
                for s in shingle_sets(part.column("text"), n):
                    if not len(s):
                        rows.append((0, None, 0, None, [], []))
                        continue
                    place = np.zeros(len(s), np.int64)
                    if len(tokens):
                        at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                        place = np.where(tokens[at] == s, places[at], 0)
                    order = np.argsort(place, kind="stable")  # s ascends
                    order = order[: prefix_size(len(s), percent) + extra(len(s), percent)]
                    rare = place[order] == 0
                    # The least set that can link with this one has this many shingles, and so this l.
                    least = extra(-(-percent * len(s) // 100), percent) + 1
                    rows.append((len(s), digest(s), least, signature(s), s[order[rare]].view(np.int64), s[order[~rare]].view(np.int64)))
                n_, digest_, least_, signature_, rare_, often_ = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_, pa.int64()), pa.array(digest_, pa.int64()), pa.array(least_, pa.int64()), pa.array(signature_, pa.binary()), pa.array(rare_, pa.list_(pa.int64())), pa.array(often_, pa.list_(pa.int64())), *(part.column(c) for c in more)],
                    ["doc_id", "n", "digest", "least", "signature", "rare", "often", *more],
                )
            give_back()

    return run


class Trie:
    """Sets of ranks as a path-compressed trie. ranks: ascending arrays; sizes: of the full sets, which may hold more."""

    def __init__(self, ranks: list[np.ndarray], sizes: np.ndarray):
        keys = [r.astype(">u4").tobytes() for r in ranks]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__))
        sets = [ranks[i] for i in self.order]
        lengths = np.array([len(s) for s in sets])
        self.sizes = sizes[self.order]
        common = np.zeros(len(sets), np.int64)  # with the set before
        for i in range(1, len(sets)):
            a, b = sets[i - 1], sets[i]
            k = min(len(a), len(b))
            differ = np.flatnonzero(a[:k] != b[:k])
            common[i] = differ[0] if len(differ) else k
        tokens, cut, parent, lo_, own, least, most = [], [0], [], [], [], [], []
        stack = [(0, len(sets), 0, -1)]
        while stack:
            lo, hi, depth, up = stack.pop()
            inner = common[lo + 1 : hi]
            end = int(inner.min()) if hi - lo > 1 else int(lengths[lo])
            node = len(parent)
            parent.append(up)
            tokens.append(sets[lo][depth:end])
            cut.append(cut[-1] + end - depth)
            ending = int(np.searchsorted(lengths[lo:hi] > end, True)) if lengths[lo] == end else 0
            lo_.append(lo)
            own.append(ending)
            least.append(int(self.sizes[lo:hi].min()))
            most.append(int(lengths[lo:hi].max()) - end)
            begins = [lo + ending, *(lo + 1 + np.flatnonzero(inner == end)).tolist(), hi]
            begins = sorted({b for b in begins if b >= lo + ending})
            for a, b in zip(begins[:-1], begins[1:], strict=True):
                stack.append((a, b, end, node))
        self.tokens, self.cut = np.concatenate(tokens), np.array(cut)
        self.lo, self.own, self.least, self.most = map(np.array, (lo_, own, least, most))
        by_parent = np.argsort(parent, kind="stable")
        self.children = by_parent
        self.first_child = np.searchsorted(np.array(parent)[by_parent], np.arange(-1, len(parent) + 1))
        self.ends = np.array([t[-1] if len(t) else -1 for t in tokens])

    def near(self, x: np.ndarray, size: int, percent: int, ranks: int) -> np.ndarray:
        """The sets, by their number in ranks, whose Jaccard similarity with x is percent / 100 or more."""
        held = np.zeros(ranks + 1, bool)
        held[x] = True
        at, overlap = np.array([0]), np.array([0])
        found = []
        while len(at):
            begin, n = self.cut[at], self.cut[at + 1] - self.cut[at]
            if (total := int(n.sum())):
                stops = np.cumsum(n)
                inside = held[self.tokens[np.repeat(begin - (stops - n), n) + np.arange(total)]]
                sums = np.concatenate(([0], np.cumsum(inside)))
                overlap = overlap + sums[stops] - sums[stops - n]
            remain = np.where(self.ends[at] >= 0, len(x) - np.searchsorted(x, self.ends[at], "right"), len(x))
            can = overlap + np.minimum(remain, self.most[at])
            keep = (100 + percent) * can >= percent * (size + self.least[at])
            at, overlap = at[keep], overlap[keep]
            own = self.own[at]
            if own.any():
                which = np.repeat(self.lo[at], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
                o = np.repeat(overlap, own)
                found.append(which[100 * o >= percent * (size + self.sizes[which] - o)])
            first, last = self.first_child[at + 1], self.first_child[at + 2]
            n = last - first
            at = self.children[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            overlap = np.repeat(overlap, n)
        return self.order[np.concatenate(found)] if found else np.zeros(0, np.int64)


def group_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect the sets of a group, as numbers: sets have a path of links if and only if they have one by these."""
    sizes = np.array([len(s) for s in sets])
    alive = np.arange(len(sets))
    for _ in range(3):  # shingles that no other set has can't overlap; sets with too many of them link with nothing
        if len(alive) < 2:
            return []
        tokens = np.concatenate([sets[i] for i in alive])
        owner = np.repeat(np.arange(len(alive)), sizes[alive])
        values, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        keep = counts[inverse] > 1
        shared = np.bincount(owner[keep], minlength=len(alive))
        ok = 100 * shared >= percent * sizes[alive]
        if ok.all():
            break
        alive = alive[ok]
    else:
        if len(alive) < 2:
            return []
        tokens = np.concatenate([sets[i] for i in alive])
        owner = np.repeat(np.arange(len(alive)), sizes[alive])
        values, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        keep = counts[inverse] > 1
        shared = np.bincount(owner[keep], minlength=len(alive))
    if len(alive) == 2:
        o = int(shared[0])
        return [(int(alive[0]), int(alive[1]))] if 100 * o >= percent * (int(sizes[alive].sum()) - o) else []
    # In the group, shingles of many sets come first, so that sets share long paths.
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -counts))] = np.arange(len(values))
    token_rank, owner = rank[inverse[keep]], owner[keep]
    order = np.lexsort((token_rank, owner))
    ranks = np.split(token_rank[order], np.cumsum(shared)[:-1])
    full = sizes[alive]
    trie = Trie(ranks, full)
    root = list(range(len(alive)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    # First the set whose shingles are most common in the group.
    typical = np.bincount(owner, weights=counts[inverse[keep]], minlength=len(alive)) / full
    first = int(np.argmax(typical))
    done = np.zeros(len(alive), bool)
    for x in [first, *(i for i in range(len(alive)) if i != first)]:
        if done[x]:
            continue
        for y in trie.near(ranks[x], int(full[x]), percent, len(values)).tolist():
            if x == first:
                done[y] = True
            a, b = find(x), find(y)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(alive[x]), int(alive[y])))
    return links


def _groups(batches, *keys: str):
    """Rows of batches that are sorted by the keys, as one table for each group; a group may go over batches."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            new |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(c[lo] for c in columns)
            if held and now != key:
                yield held
                held = []
            key = now
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield held


def _near(percent: int):
    """Members, sorted by (pivot, block), that may have a link in their block; where some are guests, a link with a guest."""

    def run(batches):
        for group in _groups(batches, "pivot", "block"):
            t = pa.Table.from_batches(group).combine_chunks()
            guest = t.column("guest").to_numpy(zero_copy_only=False)
            kept = t.filter(pa.array(with_partner(t.column("signature").to_pylist(), t.column("n").to_numpy(), percent, guest if guest.any() else None, t.column("digest").to_numpy())))
            yield from kept.select(["pivot", "block", "key"]).to_batches()

    return run


def _link(n: int, percent: int):
    """Texts of groups, sorted by (pivot, block), to links."""

    def run(batches):
        for group in _groups(batches, "pivot", "block"):
            # Digests are taken from the texts, as rows that share an id may have different ones.
            own = {digest(s): s for b in group for p in parts(b) for s in shingle_sets(p.column("text"), n) if len(s)}
            digests = list(own)
            found = group_links(list(own.values()), percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([digests[a] for a, _ in found], pa.int64()), pa.array([digests[b] for _, b in found], pa.int64())], ["src", "dst"])
        give_back()

    return run


def _groups_of(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(pivot, digest, key, n, signature): the groups of each set, without those it leaves."""
    # Rare shingles: the least and the greatest holder are an aggregate, and only shingles with two holders go back to
    # their rows, so the rows of one shingle needn't meet. Frequent ones: a row for each comes back.
    held = sets.select(F.explode("rare").alias("token"), "digest")
    ends = held.groupBy("token").agg(F.min("digest").alias("pivot"), F.max("digest").alias("most")).where("pivot <> most")
    rare = held.join(ends, "token").select("digest", "pivot", "most")
    often = sets.select(F.explode("often").alias("token"), "digest")
    heads = often.groupBy("token").agg(F.min("digest").alias("pivot"), F.max("digest").alias("most"))
    both = rare.unionByName(often.join(F.broadcast(heads), "token").select("digest", "pivot", "most")).where("pivot <> most")
    # All copies of a set have the same shingles.
    met = both.groupBy("digest", "pivot").agg(F.count("*").alias("rows")).join(classes, "digest").withColumn("shared", F.col("rows") / F.col("copies"))
    own = W.partitionBy("digest")
    met = met.withColumn("all", F.sum("shared").over(own)).withColumn("left", F.sum("shared").over(own.orderBy("shared", F.col("pivot").desc()).rowsBetween(W.unboundedPreceding, 0)))
    return met.where((F.col("all") >= F.col("least")) & (F.col("left") * 2 > F.col("least") - 1)).select("pivot", "digest", "key", "n", "signature")


def near_duplicates(
    docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", block_sets: int = BLOCK_SETS, broadcast_rows: int = BROADCAST_ROWS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id that links of Jaccard similarity percent / 100 or more reach; then docs' columns named in carry."""
    spark = docs.sparkSession
    low = F.lit(-(1 << 63))
    more = tuple(f"c{i}" for i in range(len(carry)))
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *(F.col(f"`{c}`").alias(m) for c, m in zip(carry, more, strict=True)))
    counted = own.select("text").mapInArrow(_frequent(n), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    # At most FREQUENT rows come to the driver.
    top = counted.orderBy(F.col("n").desc(), "token").limit(FREQUENT).toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    frequent = spark.sparkContext.broadcast((tokens[order], (len(tokens) - np.arange(len(tokens)))[order].astype(np.int64)))
    schema = "doc_id long, n long, digest long, least long, signature binary, rare array<long>, often array<long>" + "".join(f", {m} {own.schema[m].dataType.simpleString()}" for m in more)
    sets = save(own.mapInArrow(_prefixes(n, percent, frequent, more), schema), "shingle-prefixes")
    key = F.coalesce("doc_id", low)
    classes = save(sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.min(key).alias("key"), F.first("n").alias("n"), F.first("least").alias("least"), F.first("signature").alias("signature"), F.count("*").alias("copies")), "shingle-classes")
    members = save(_groups_of(sets, classes), "shingle-groups")
    blocks = members.groupBy("pivot").agg(F.count("*").alias("m"), F.sum("n").alias("total"), F.min("digest").alias("hub")).where("m > 1")
    blocks = save(blocks.select("pivot", "hub", F.ceil(F.greatest(F.col("m") / block_sets, F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks")), "shingle-blocks")
    placed = members.join(blocks, "pivot")
    block = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)

    def linked(dealt: DataFrame) -> DataFrame:
        """Links of what is dealt to (pivot, block), by signatures first."""
        sorted_ = dealt.select("pivot", "block", "digest", "key", "n", "signature", "guest").repartition("pivot", "block").sortWithinPartitions("pivot", "block")
        wanted = save(sorted_.mapInArrow(_near(percent), "pivot long, block int, key long"), "shingle-members")
        # Few members are sent to the texts, which then stay where they are; many are joined by a shuffle of both.
        few = wanted.count() <= broadcast_rows
        with_text = own.select(key.alias("key"), "text").join(F.broadcast(wanted) if few else wanted, "key")
        texts_ = with_text.select("pivot", "block", "text").repartition("pivot", "block").sortWithinPartitions("pivot", "block")
        out = save(texts_.mapInArrow(_link(n, percent), "src long, dst long"), "shingle-links")
        discard(wanted)
        return out

    # The hub stands in each block of its group.
    links = linked(placed.withColumn("block", F.explode(F.when(F.col("digest") == F.col("hub"), every).otherwise(F.array(block)))).withColumn("guest", F.lit(False)))
    if not blocks.where("blocks > 1").isEmpty():
        # Sets of large groups that aren't connected to their hub meet every block.
        of = connected_components(links)
        large = placed.where("blocks > 1").withColumn("home", block)
        large = large.join(of.select(F.col("node").alias("digest"), F.col("component").alias("c")), "digest", "left").join(of.select(F.col("node").alias("hub"), F.col("component").alias("p")), "hub", "left")
        large = save(large.withColumn("outside", ~F.coalesce(F.col("c") == F.col("p"), F.lit(False)) & (F.col("digest") != F.col("hub"))), "shingle-outside")
        parts_ = large.where("outside").groupBy("pivot").agg(F.ceil(F.greatest(F.count("*") / block_sets, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("outer"))
        again = large.join(parts_, "pivot")
        part = F.pmod(F.xxhash64("digest", F.lit(7)), F.col("outer")).cast("int")
        outer = F.sequence(F.lit(0), F.col("outer") - 1)
        homes = again.withColumn("block", F.explode(F.transform(outer, lambda o: o * F.col("blocks") + F.col("home")))).withColumn("guest", F.lit(False))
        guests = again.where("outside").withColumn("part", part).withColumn("block", F.explode(F.transform(every, lambda b: F.col("part") * F.col("blocks") + b))).withColumn("guest", F.lit(True))
        columns = ["pivot", "block", "digest", "key", "n", "signature", "guest"]
        links = links.union(linked(homes.select(columns).union(guests.select(columns))))
        discard(large)
    of = save(connected_components(links).join(classes.select(F.col("digest").alias("node"), "doc_id"), "node"), "shingle-components")
    least = of.groupBy("component").agg(F.min("doc_id").alias("first_id"))
    known = of.join(least, "component").select(F.col("node").alias("digest"), "first_id")
    names = classes.join(known, "digest", "left").select("digest", F.coalesce("first_id", "doc_id").alias("component_id"))
    out = sets.select("doc_id", "n", "digest", *more).join(names, "digest", "left")
    discard(members, blocks)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), *(F.col(m).alias(c) for m, c in zip(more, carry, strict=True)))
