"""N-gram Jaccard self-join by universe partition and pigeonhole.

A document is its set of distinct word shingles. Two sets with Jaccard
similarity of at least ``pct`` percent differ in at most
H = (|x| + |y|) (100 - pct) / (100 + pct) members. For every size band the
universe of shingle hashes is cut into somewhat more than H segments, so
that linked sets agree exactly in some segment that is not empty in either.
The sub-sets of the segments are indexed by hash. A set is in the band of
its size, and in the next one if a partner there is possible; the larger
set's band decides where a pair meets.

Allocation by cost. A segment counts 0, 1 or 2 towards the H + 1 that a set
needs. Empty segments count 0. A segment whose group holds more than
``LIST`` sets that are not known to be connected is costly: it counts 0 as
well. All others count 1 (they must agree). Where that leaves a set short,
its one-deletion neighbourhoods are indexed as well, and a segment of two or
more members counts 2 (it may differ by one member; an emptied segment is
not indexed, so one member still counts 1). Sets that are still short are compared with
each other block by block. A pair is lost only if both sides are short
after all of that, which the block comparison rules out.

Groups are met by stars first: members are compared with the group's pivot.
In small groups, the other pairs of different components are candidates if
they agree in as many segments as linked sets of their kind must (a set has
more non-empty segments than it needs, and all but H of them agree). Sets
with more spare segments than large groups are settled there. The others of
a large group get other pivots while they are not yet connected; tasks
collapse their own part of a large group before the shuffle. Candidates
whose sizes or parity sketches (a bit per member) rule a link out are
dropped, the others are verified exactly on the whole sets.

Equal sets form one class from the start. Hashes are 64-bit; class ids are
checked for collisions and drawn anew if there is one.

Edge cases: null texts, empty texts and texts without words have no
shingles, link with nothing and are their own component; rows that repeat
an id or a text are rows of the same class; a null id never becomes a
component id (null where no id is connected); ties do not matter; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import SHINGLE, SIMILARITY_PCT, arrow_map, mix, release, shingle_sets, written
from tokenmill.llm.components import components
from tokenmill.llm.idfilter import KeyFilter, without
from tokenmill.llm.lm import by_bucket

LIST = 32  # sets that a group may hold before it is met by stars
SEGMENTS_PER_MEMBER, SPARE_SEGMENTS = 0.33, 8
UNIT_SHINGLES, UNIT_DOCS = 800_000, 30_000  # a task's share that is held at once
BYTES_PER_BUCKET = 20 << 20
SEEN = 200_000  # classes a task remembers, to send copies once
STAR_ROUNDS, STAR_YIELD = 3, 0.01  # rounds of other pivots, while this share of their pairs is linked
STAR_ASKS = 4  # groups in which a set is compared with the pivot in a round
COMPARE_BLOCK = 256


def class_id(members: np.ndarray, seed: int) -> tuple[int, int]:
    """(id, check): two signed 64-bit numbers of a set's content."""
    h = xxhash.xxh3_128_intdigest(members.tobytes(), seed)
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def sketch(members: np.ndarray) -> bytes:
    """Parity of the members in each of 2^k slots, 2^k at least the set's
    size: two sketches differ in at most as many bits as the sets in members."""
    slots = max(64, 1 << int(len(members) - 1).bit_length())
    at = (members >> np.uint64(20)) & np.uint64(slots - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=slots) & 1).astype(bool), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Lower bound of the number of members in which two sets differ."""
    if len(a) < len(b):
        a, b = b, a
    x = int.from_bytes(a, "little")
    for half in (8 * len(a) >> s for s in range(1, 64)):
        if half < 8 * len(b):
            break
        x = (x >> half) ^ (x & ((1 << half) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


def band(n: np.ndarray) -> np.ndarray:
    """The b for which ``2**(b-1) < n <= 2**b``."""
    return np.ceil(np.log2(np.maximum(n, 1)) - 1e-12).astype(np.int64)


def segments(b: np.ndarray) -> np.ndarray:
    return (SEGMENTS_PER_MEMBER * 2.0 ** b).astype(np.int64) + SPARE_SEGMENTS


def needed(n: np.ndarray, b: np.ndarray, pct: int) -> np.ndarray:
    """H + 1 for a set of size ``n`` and its largest possible partner in band ``b``."""
    partner = np.minimum(100 * n // pct, 2 ** b)
    return (n + partner) * (100 - pct) // (100 + pct) + 1


def parts(sets: list[np.ndarray], bands: np.ndarray) -> tuple[np.ndarray, ...]:
    """Non-empty segments of all sets: (set, segment, members in it, sum of member hashes)
    and the order of the members by set and segment."""
    sizes = np.array([len(s) for s in sets], np.int64)
    e = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    with np.errstate(over="ignore"):
        place = mix(e + np.uint64(0x51ED270B5D2C9A17))
        seg = ((place >> np.uint64(32)) * segments(bands)[owner].astype(np.uint64)) >> np.uint64(32)
        key = (owner.astype(np.uint64) << np.uint64(32)) | seg
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        member = mix(place)[order]
        total = np.add.reduceat(member, first)
    count = np.diff(np.append(first, len(key)))
    return (key[first] >> np.uint64(32)).astype(np.int64), key[first] & np.uint64(0xFFFFFFFF), count, total, member, first


def signature(b: np.ndarray, seg: np.ndarray, count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """48-bit hash of a sub-set of a segment."""
    with np.errstate(over="ignore"):
        at = mix((b.astype(np.uint64) << np.uint64(40)) + seg)
        return mix(total + at + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)


def roles(sizes: np.ndarray, pct: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(role, sets, bands): role 0 is a set's own band, role 1 the next one where a partner is possible."""
    own = band(sizes)
    up = np.flatnonzero(100 * sizes // pct > 2 ** own)
    return [(0, np.arange(len(sizes)), own), (1, up, own[up] + 1)]


def pack48(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def unit_rows(sids: list[int], sets: list[np.ndarray], buckets: int, pct: int):
    """Rows of one task's share (see ``group_signatures``)."""
    names = np.array(sids, np.int64)
    sizes = np.array([len(s) for s in sets], np.int64)
    sig, who = [], []
    for role, members, bands in roles(sizes, pct):
        if not len(members):
            continue
        owner, seg, count, total = parts([sets[i] for i in members], bands)[:4]
        sig.append(signature(bands[owner], seg, count, total))
        who.append((members[owner] * 2 + role).astype(np.uint16))
        slack = np.bincount(owner, minlength=len(members)) - needed(sizes[members], bands, pct)
        yield "slack", -1, None, None, names[members].astype("<i8").tobytes(), (slack * 2 + role).astype("<i4").tobytes(), None
    sig, who = np.concatenate(sig), np.concatenate(who)
    order = np.argsort(sig)
    sig, who = sig[order], who[order]
    del order
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    sizes_here = np.diff(np.append(first, len(sig)))
    keep = np.ones(len(sig), bool)
    for g in np.flatnonzero(sizes_here > LIST):  # collapse a large group here: its pivot stands for it
        at = slice(first[g], first[g] + sizes_here[g])
        ids, its_roles = names[who[at] >> 1], (who[at] & 1).astype(np.uint8)
        pivot = int(ids.min())
        s = int(sig[first[g]].astype(np.int64))
        keep[at] = False
        yield "star", s, pivot, None, ids.astype("<i8").tobytes(), its_roles.tobytes(), None
        yield "pivot", s, pivot, int(np.uint64(sig[first[g]]) >> np.uint64(24)) % buckets, None, \
            bytes([int(its_roles[int(ids.argmin())])]), None
    sig, who = sig[keep], who[keep]
    for b, at in by_bucket((sig >> np.uint64(24)) % np.uint64(buckets)):
        used, local = np.unique(who[at] >> 1, return_inverse=True)
        packed = (local.astype(np.uint16) * 2 + (who[at] & 1).astype(np.uint16)).astype("<u2").tobytes()
        yield "entries", -1, None, b, names[used].astype("<i8").tobytes(), packed, pack48(sig[at])


def group_rows(pdf: pd.DataFrame):
    """Groups of one bucket: lists of at most ``LIST`` sets, and stars of larger groups."""
    own = pdf[pdf["kind"] == "entries"]
    hot = pdf[pdf["kind"] == "pivot"]
    sig = [unpack48(x) for x in own["sigs"]] + [hot["sig"].to_numpy(np.int64).view(np.uint64)]
    sid, role = [], []
    for ids, packed in zip(own["members"], own["roles"], strict=True):
        p = np.frombuffer(packed, "<u2")
        sid.append(np.frombuffer(ids, "<i8")[p >> 1])
        role.append((p & 1).astype(np.uint8))
    sid.append(hot["pivot"].to_numpy(np.int64))
    role.append(np.array([x[0] for x in hot["roles"]], np.uint8))
    sig, sid, role = np.concatenate(sig), np.concatenate(sid), np.concatenate(role)
    order = np.argsort(sig)
    sig, sid, role = sig[order], sid[order], role[order]
    large = np.unique(hot["sig"].to_numpy(np.int64).view(np.uint64))
    same = sig[1:] == sig[:-1]
    keep = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(sig) else np.zeros(0, bool)
    keep |= np.isin(sig, large)
    sig, sid, role = sig[keep], sid[keep], role[keep]  # most signatures occur once
    order = np.lexsort((sid, sig))
    sig, sid, role = sig[order], sid[order], role[order]
    new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])]) if len(sig) else np.zeros(0, bool)
    sig, sid, role = sig[new], sid[new], role[new]  # copies sent by several tasks
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(sig)))
    is_hot = (size > LIST) | np.isin(sig[first], large)
    lists: Counter[bytes] = Counter()
    for g in np.flatnonzero((size > 1) | is_hot):
        at = slice(first[g], first[g] + size[g])
        if is_hot[g]:
            yield "star", int(sig[first[g]].astype(np.int64)), int(sid[first[g]]), sid[at].astype("<i8").tobytes(), \
                role[at].tobytes(), 1
        else:
            lists[sid[at].astype("<i8").tobytes()] += 1
    for x, n in sorted(lists.items()):
        yield "list", None, None, x, None, n


def task_classes(batches, seed: int, width: int, keys: KeyFilter | None = None):
    """The classes of a task's rows ``(ref, text)``, each at most once (or
    again after ``SEEN`` others): lists of ids and of sets, some rows at a
    time. With ``keys``, only rows whose ``ref`` may be among them."""
    seen: set[int] = set()
    for b in batches:
        texts = b.column(1)
        if keys is not None:
            texts = texts.filter(pa.array(keys.hits(b.column(0))))
        for at in range(0, len(texts), 200):
            sids, sets = [], []
            for s in shingle_sets(texts.slice(at, 200).to_pylist(), width):
                if len(s) and (sid := class_id(s, seed)[0]) not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(sid)
                    sids.append(sid)
                    sets.append(s)
            yield sids, sets


_GROUPED = "kind string, sig long, pivot long, members binary, roles binary, n long"


def group_signatures(docs: DataFrame, buckets: int, seed: int, pct: int, width: int) -> DataFrame:
    """Groups of sets that share a signature.

    Rows ``kind, sig, pivot, members, roles, n``: a ``list`` holds up to
    ``LIST`` class ids that share ``n`` signatures, a ``star`` the members of
    (one task's part of) a larger group with its pivot, ``slack`` how many
    more segments than it needs each set has."""
    sent = "kind string, sig long, pivot long, bucket long, members binary, roles binary, sigs binary"

    def run(batches):
        sids, sets, total = [], [], 0

        def flush():
            rows = list(unit_rows(sids, sets, buckets, pct)) if sids else []
            # stars and slacks only pass through: any bucket will do
            rows = [(k, s, p, (hash((s, i)) % buckets if b is None else b), m, r, x)
                    for i, (k, s, p, b, m, r, x) in enumerate(rows)]
            cols = list(zip(*rows)) if rows else [()] * 7
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                              ["kind", "sig", "pivot", "bucket", "members", "roles", "sigs"])

        for new, their_sets in task_classes(batches, seed, width):
            for sid, members in zip(new, their_sets, strict=True):
                sids.append(sid)
                sets.append(members)
                total += len(members)
                if total >= UNIT_SHINGLES or len(sids) >= UNIT_DOCS:
                    yield flush()
                    sids, sets, total = [], [], 0
        yield flush()
        sids, sets = [], []
        release()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        through = pdf[pdf["kind"].isin(["star", "slack"])]
        rows = [(*x, 1) for x in zip(*[through[c] for c in ("kind", "sig", "pivot", "members", "roles")])] + list(group_rows(pdf))
        out = pd.DataFrame(rows, columns=["kind", "sig", "pivot", "members", "roles", "n"])
        release()
        return out.astype({"sig": "Int64", "pivot": "Int64"})

    return docs.select("ref", "text").mapInArrow(run, sent).groupBy("bucket").applyInPandas(merge, _GROUPED)


class Join:
    """State of one join: documents, classes, links so far and their components."""

    def __init__(self, docs: DataFrame, classes: DataFrame, seed: int, pct: int, width: int):
        self.docs, self.classes, self.seed, self.pct, self.width = docs, classes, seed, pct, width
        self.roots: DataFrame | None = None

    def sets(self, sids: DataFrame) -> DataFrame:
        """(sid, shingles) of the classes in ``sids(sid)``: only texts picked
        by the hash of one text of each class are read as sets again."""
        refs = sids.join(self.classes.select("sid", "ref"), "sid").select("ref")
        seed, width = self.seed, self.width
        keys = self.docs.sparkSession.sparkContext.broadcast(KeyFilter.build(refs))

        def run(batches):
            for names, sets in task_classes(batches, seed, width, keys.value):
                yield pa.RecordBatch.from_pydict({"sid": pa.array(names, pa.int64()), "shingles": pa.array(
                    [s.tobytes() for s in sets], pa.binary())})

        found = self.docs.select("ref", "text").mapInArrow(run, "sid long, shingles binary")
        made = written(found.join(sids, "sid", "left_semi").dropDuplicates(["sid"]), "sets")
        keys.destroy()  # the table is there; nothing runs this again
        return made

    def verify(self, pairs: DataFrame) -> float:
        """Add the linked pairs among ``pairs(a, b)`` and renew the components; the share that is linked."""
        pairs = written(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), "pairs")
        asked = pairs.count()
        pairs = self.plausible(pairs)
        sets = self.sets(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct())
        pct = self.pct

        def check(a, b, x, y):
            keep = []
            for p, q, s, t in zip(a, b, x, y, strict=True):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                if min(len(s), len(t)) * 100 < pct * max(len(s), len(t)):
                    continue
                both = np.concatenate([s, t])
                both.sort(kind="stable")
                n = int((both[1:] == both[:-1]).sum())
                if 100 * n >= pct * (len(both) - n):
                    keep.append((p, q))
            return tuple(zip(*keep)) if keep else ((), ())

        def side(end):
            return sets.select(F.col("sid").alias(end), F.col("shingles").alias(f"set_{end}"))

        whole = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b")
        return self.add(arrow_map(whole, check, "a long, b long")) / max(1, asked)

    def plausible(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches do not rule a link out."""
        pct = self.pct

        def check(a, b, x, y, n, m):
            keep = [(p, q) for p, q, s, t, i, j in zip(a, b, x, y, n, m, strict=True)
                    if 100 * min(i, j) >= pct * max(i, j)
                    and sketch_distance(s, t) * (100 + pct) <= (i + j) * (100 - pct)]
            return tuple(zip(*keep)) if keep else ((), ())

        def side(end):
            return self.classes.select(F.col("sid").alias(end), F.col("sketch").alias(f"x_{end}"), F.col("n").alias(f"n_{end}"))

        known = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "x_a", "x_b", "n_a", "n_b")
        return written(arrow_map(known, check, "a long, b long"), "plausible")

    def add(self, links: DataFrame) -> int:
        links = written(links, "links")
        n = links.count()
        if self.roots is None:
            self.roots = components(links)
        elif n:
            # only the components that the new links touch change
            met = components(self.rooted(self.rooted(links, "a", "x"), "b", "y").select(F.col("x").alias("a"), F.col("y").alias("b")))
            to = met.select(F.col("node").alias("root"), F.col("root").alias("_to"))
            known = self.roots.join(to, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
            self.roots = written(known.union(met.join(self.roots, "node", "left_anti").select("node", "root")), "roots")
        return n

    def rooted(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """``df`` with the component of the class in ``column``."""
        named = self.roots.select(F.col("node").alias(column), F.col("root").alias(out))
        return df.join(named, column, "left").withColumn(out, F.coalesce(out, column))


def members_of(stars: DataFrame) -> DataFrame:
    """One row per member of the stars."""
    def run(sigs, pivots, members, its_roles):
        out = [(s, p, i, x) for s, p, m, r in zip(sigs, pivots, members, its_roles, strict=True)
               for i, x in zip(np.frombuffer(m, "<i8").tolist(), r, strict=True)]
        return tuple(zip(*out)) if out else ((),) * 4

    return arrow_map(stars.select("sig", "pivot", "members", "roles"), run, "sig long, pivot long, member long, role int")


def list_members(lists: DataFrame) -> DataFrame:
    """One row per member of the lists; the first is the pivot of the others."""
    def run(members, counts):
        out = []
        for m, n in zip(members, counts, strict=True):
            ids, label = np.frombuffer(m, "<i8").tolist(), xxhash.xxh3_64_intdigest(m) - (1 << 63)
            out += [(label, ids[0], i, n) for i in ids]
        return tuple(zip(*out)) if out else ((),) * 4

    return arrow_map(lists.select("members", "n"), run, "sig long, pivot long, member long, n long")


def slacks(groups: DataFrame) -> DataFrame:
    """(sid, role, slack): non-empty segments of a set less those it needs."""
    def run(members, packed):
        ids = np.concatenate([np.frombuffer(m, "<i8") for m in members] or [np.empty(0, np.int64)])
        both = np.concatenate([np.frombuffer(x, "<i4") for x in packed] or [np.empty(0, np.int32)])
        return ids, both & 1, both >> 1

    return arrow_map(groups.where("kind = 'slack'").select("members", "roles"), run,
                     "sid long, role int, slack int").distinct()


def cross_pairs(groups: DataFrame) -> DataFrame:
    """Pairs of different components in ``groups(ids, tops)``, arrays of at most ``LIST`` members."""
    def run(ids, tops):
        out = [(a, b) for i, t in zip(ids, tops, strict=True)
               for (a, p), (b, q) in combinations(sorted(zip(i, t, strict=True)), 2) if p != q]
        return tuple(zip(*out)) if out else ((), ())

    return arrow_map(groups.select("ids", "tops"), run, "a long, b long")


def agreeing_pairs(groups: DataFrame, pct: int) -> DataFrame:
    """Pairs of the open lists that agree in as many segments as a linked
    pair must. ``groups(pivot, n, each)``: ``each`` holds (member, top,
    needs, size) of at most ``LIST`` members. Pairs with a pivot were decided
    in its star, so all signatures of the others are counted here."""
    def run(pivots, counts, each):
        out = []
        for p, n, members in zip(pivots, counts, each, strict=True):
            rest = sorted((m["member"], m["top"], m["needs"], m["size"]) for m in members if m["member"] != p)
            out += [(a, b, n, max(s, t)) for (a, x, s, k), (b, y, t, m) in combinations(rest, 2)
                    if x != y and 100 * min(k, m) >= pct * max(k, m)]
        return tuple(zip(*out)) if out else ((),) * 4

    met = arrow_map(groups.select("pivot", "n", "each"), run, "a long, b long, n long, needs long")
    return met.groupBy("a", "b").agg(F.sum("n").alias("met"), F.max("needs").alias("needs")).where("met >= needs").select("a", "b")


def finish_lists(join: Join, lists: DataFrame, stars: DataFrame, slack: DataFrame) -> None:
    """Compare what a list's star left open: members of different components
    (the star's own pairs were decided already).

    Linked sets differ in fewer segments than they need, so they agree in at
    least ``slack + 1`` non-empty ones; those in large groups are not in lists."""
    hot = stars.groupBy(F.col("member").alias("sid"), "role").agg(F.count(F.lit(1)).alias("hot"))
    needs = slack.join(hot, ["sid", "role"], "left").groupBy("sid").agg(
        F.min(F.col("slack") + 1 - F.coalesce("hot", F.lit(0))).alias("needs"))
    known = join.classes.select("sid", F.col("n").alias("size")).join(needs, "sid").withColumnRenamed("sid", "member")
    rest = lists.where(F.octet_length("members") > 16)  # two members: the star was the pair
    each = join.rooted(list_members(rest), "member", "top").join(known, "member")
    open_ = each.groupBy("sig").agg(F.collect_list(F.struct("member", "top", "needs", "size")).alias("each"),
                                    F.first("pivot").alias("pivot"), F.first("n").alias("n"))
    open_ = open_.where(F.size(F.array_distinct(F.transform("each", lambda m: m["top"]))) > 1)
    pairs = written(agreeing_pairs(open_, join.pct), "open")
    if not pairs.isEmpty():
        join.verify(pairs)


def short_members(stars: DataFrame, slack: DataFrame) -> DataFrame:
    """Members ``(sig, member, role)`` of the large groups that have no more
    spare segments than large groups.

    Any other set agrees with a linked one in a small group too, where the
    pair was decided, so only pairs of two short sets are open."""
    members = stars.select("sig", "member", "role").distinct()
    hot = members.groupBy(F.col("member").alias("sid"), "role").agg(F.count(F.lit(1)).alias("hot"))
    short = slack.join(hot, ["sid", "role"]).where("slack < hot").select(F.col("sid").alias("member"), "role")
    return written(members.join(short, ["member", "role"], "left_semi"), "short")


def open_stars(join: Join, stars: DataFrame) -> DataFrame:
    """Members of the large groups that are not within one component."""
    both = join.rooted(stars, "member", "top")
    tops = both.groupBy("sig").agg(F.min("top").alias("low"), F.max("top").alias("high"))
    return both.join(tops.where("low <> high").select("sig"), "sig", "left_semi")


def finish_stars(join: Join, stars: DataFrame, slack: DataFrame) -> None:
    """Give the short sets of large open groups other pivots, then deletions, then each other."""
    stars = short_members(stars, slack)
    for attempt in range(STAR_ROUNDS):
        left = written(open_stars(join, stars), "stars")
        if left.isEmpty():
            break
        # a member of the group's largest component, in an order that all groups
        # share: only sets outside that component are compared, mostly with the same pivots
        order = F.struct(F.xxhash64("member", F.lit(attempt)), "member")
        tops = left.groupBy("sig", "top").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
        pivots = tops.groupBy("sig").agg(F.min(F.struct(-F.col("n"), "first", "top")).alias("p")).select(
            "sig", F.col("p.first.member").alias("b"), F.col("p.top").alias("p_top"))
        # a set asks in a few of its groups, in an order that near copies share; a round need not settle all
        asks = left.groupBy("member", "top").agg(F.array_sort(F.collect_set(
            F.struct(F.xxhash64("sig", F.lit(attempt)).alias("order"), "sig"))).alias("sigs"))
        asks = asks.select("member", "top", F.explode(F.slice("sigs", 1, STAR_ASKS)).alias("ask"))
        compared = (asks.select("member", "top", "ask.sig").join(pivots, "sig").where("top <> p_top")
                    .select(F.col("member").alias("a"), "b"))
        if join.verify(compared) < STAR_YIELD:
            break
    lost = open_stars(join, stars).groupBy(F.col("member").alias("sid"), "role").agg(F.countDistinct("sig").alias("lost"))
    lost = written(slack.join(lost, ["sid", "role"], "left").withColumn("lost", F.coalesce("lost", F.lit(0).cast("long")))
                   .where("slack < lost").select("sid", "role", "lost"), "lost")
    if lost.isEmpty():
        return
    still = deletion_round(join, lost)
    if not still.isEmpty():
        compare_blocks(join, still)


def deletion_round(join: Join, lost: DataFrame) -> DataFrame:
    """Index the short sets' segments and their one-deletion neighbourhoods;
    returns those that are short even so: (sid, band)."""
    sets = join.sets(lost.select("sid").distinct())
    pct = join.pct

    def run(sids, its_roles, its_lost, data):
        out = []
        for sid, role, n_lost, x in zip(sids, its_roles, its_lost, data, strict=True):
            s = np.frombuffer(x, np.uint64)
            b = band(np.array([len(s)])) + role
            need = int(needed(np.array([len(s)]), b, pct)[0])
            _, seg, count, total, member, first = parts([s], b)
            if len(seg) - n_lost >= need:
                continue
            full = signature(np.repeat(b, len(seg)), seg, count, total)
            of = np.repeat(np.arange(len(seg)), count)
            with np.errstate(over="ignore"):
                less = signature(np.repeat(b, len(of)), seg[of], count[of] - 1, total[of] - member)
            less, of = less[count[of] > 1], of[count[of] > 1]  # an emptied segment matches nothing
            out += [(sid, int(b[0]), need, int(g), int(h), True, int(c))
                    for g, h, c in zip(seg, full.astype(np.int64), count, strict=True)]
            out += [(sid, int(b[0]), need, int(seg[g]), int(h), False, int(count[g]))
                    for g, h in zip(of, less.astype(np.int64), strict=True)]
        return tuple(zip(*out)) if out else ((),) * 7

    index = written(arrow_map(lost.join(sets, "sid").select("sid", "role", "lost", "shingles"), run,
                              "sid long, band int, need long, seg long, sig long, whole boolean, members long"), "deletions")
    if index.isEmpty():
        return index.select("sid", "band")
    counts = index.select("sig", "sid").distinct().groupBy("sig").count().where("count > 1")
    small = index.join(counts.where(F.col("count") <= LIST), "sig").select("sig", "sid").distinct()
    groups = join.rooted(small, "sid", "top").groupBy("sig").agg(
        F.collect_list("sid").alias("ids"), F.collect_list("top").alias("tops"))
    join.verify(cross_pairs(groups))
    hot = index.join(counts.where(F.col("count") > LIST).select("sig", F.lit(True).alias("hot")), "sig", "left")
    worth = hot.groupBy("sid", "band", "need", "seg").agg(
        F.max(F.coalesce("hot", F.lit(False)) & F.col("whole")).alias("hot_whole"),
        F.max(F.coalesce("hot", F.lit(False)) & ~F.col("whole")).alias("hot_less"),
        F.max("members").alias("members"))
    # one member: a partner without any in the segment differs by one and shares no signature
    worth = worth.groupBy("sid", "band", "need").agg(F.sum(
        F.when(F.col("hot_whole"), 0).when(F.col("hot_less") | (F.col("members") < 2), 1).otherwise(2)).alias("worth"))
    return written(worth.where("worth < need").select("sid", "band"), "still")


def compare_blocks(join: Join, still: DataFrame) -> None:
    """Compare the sets of ``still(sid, band)`` with each other, block against
    block, leaving out pairs whose components are joined already."""
    sets = join.sets(still.select("sid").distinct())
    n = still.groupBy("band").count().withColumn("m", F.ceil(F.col("count") / COMPARE_BLOCK).cast("int"))
    rows = join.rooted(still.join(n, "band"), "sid", "top").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("m")).cast("int"))
    rows = (rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
            .select("sid", "top", "band", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
            .join(sets, "sid"))
    pct = join.pct

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        sids, block = pdf["sid"].to_numpy(), pdf["block"].to_numpy()
        data = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        size = np.array([len(x) for x in data])
        _, top = np.unique(pdf["top"].to_numpy(), return_inverse=True)
        right = np.flatnonzero(block == j)
        values = np.concatenate([data[r] for r in right]) if len(right) else np.empty(0, np.uint64)
        owner = np.repeat(right, size[right])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        links = []
        for a in np.flatnonzero(block == i):
            lo, hi = np.searchsorted(values, data[a], "left"), np.searchsorted(values, data[a], "right")
            hit = np.concatenate([owner[p:q] for p, q in zip(lo, hi, strict=True) if q > p] or [np.empty(0, np.int64)])
            n = np.bincount(hit, minlength=len(sids))
            linked = (n > 0) & (100 * n >= pct * (size[a] + size - n)) & (top != top[a])
            for b in np.flatnonzero(linked):
                links.append((sids[a], sids[b]))
                top[top == top[b]] = top[a]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    join.add(rows.groupBy("band", "i", "j").applyInPandas(compare, "a long, b long"))


def link_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", pct: int = SIMILARITY_PCT,
                   width: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``df``."""
    text = F.col(text_col)
    docs = df.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("ref"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    seed = 0
    while True:
        def identify(ids, texts, refs, seed=seed):
            rows = [(len(s), *class_id(s, seed), sketch(s)) if len(s) else (0, None, None, None)
                    for at in range(0, len(texts), 200) for s in shingle_sets(texts[at:at + 200], width)]
            return ids, refs, *(zip(*rows) if rows else ((),) * 4)

        rows = written(arrow_map(docs, identify, f"doc_id {kind}, ref long, n_shingles long, sid long, check long, "
                                                 "sketch binary"), "rows")
        classes = written(rows.where("sid is not null").groupBy("sid").agg(
            F.min("doc_id").alias("least"), F.min("ref").alias("ref"), F.min("check").alias("low"),
            F.max("check").alias("high"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "classes")
        if classes.where("low <> high").isEmpty():
            break
        seed += 1
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = written(group_signatures(docs, max(8, -(-size // BYTES_PER_BUCKET)), seed, pct, width), "groups")
    lists = written(groups.where("kind = 'list'").groupBy("members").agg(F.sum("n").alias("n")), "lists")
    stars = written(members_of(groups.where("kind = 'star'")), "stars")
    slack = written(slacks(groups), "slack")
    join = Join(docs, classes, seed, pct, width)
    own = ["pivot", "member"]
    join.verify(list_members(lists).select(*own).union(stars.select(*own)).toDF("a", "b"))
    finish_lists(join, lists, stars, slack)
    finish_stars(join, stars, slack)
    known = join.rooted(classes.select("sid", "least"), "sid", "root")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select("sid", "component_id")
    return rows.join(known, "sid", "left").select(
        "doc_id", "n_shingles", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_per_component(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` (all columns) without the documents that have a linked document
    of smaller id. Rows that repeat an id stay or go together; rows without
    an id stay. Ids are whole numbers."""
    linked = link_documents(df, id_col, text_col, **options)
    gone = written(linked.where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct(), "gone")
    return without(df, id_col, gone)
