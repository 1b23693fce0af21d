"""N-gram Jaccard join with rare-first prefix filtering.

1. Every row's set of 5-word shingles (64-bit hashes) is made where the text is read;
   rows with one and the same word sequence fall into one class, by a 128-bit digest.
2. A frequency sketch over all shingles of all rows orders the shingles, rare ones
   first.  Two sets with Jaccard >= t share a shingle among the first n - ceil(t n) + 1
   of either, whatever the order, so the sketch's error costs time and never a link.
3. Prefix shingles are counted, a class once a task however many copies it has; those of a
   single class are gone from here on.
4. Links are looked for in two rounds.  The first pairs every class with the centre of each
   of its prefix shingles (never all with all): the class with the fewest shingles of its
   own, in a group of near copies the text they were made from.  Pairs are dropped by
   length, by position and by suffix, the rest is verified exactly, and components merge.
   Afterwards only shingles whose classes are still in different components are of
   interest; the second round pairs exactly those across components.  There the smaller set
   is only indexed by its first n - ceil(2t n / (1 + t)) + 1 shingles, and a set only looks
   among the sizes that the place of the shared shingle leaves open.  A pair left out is in
   one component already.
   So components are exact and a group of g near copies costs about g pairs.

A centre with many pairs is verified in chunks of them; its text goes once to each chunk.

Defined results
---------------
* null or empty text, or white space only: the empty set, linked with nothing.
* fewer than five words: the whole sequence is the one shingle.
* repeated rows (equal texts) are one class; rows with equal ids keep a row each, with the
  links of their own text.
* a row without an id is linked through its exact copies only and takes their least id.
* very long texts are processed whole; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, giving_back
from .graph import components

PERCENT, WORDS = 80, 5
#: Buckets of the frequency sketch: its size, 1 byte each, is all that is broadcast.
WIDTH, CHUNK = 1 << 22, 1 << 18
#: Pairs of one centre that are verified in one go.
PAIRS = 256
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], k: int = WORDS) -> np.ndarray:
    """Distinct shingle hashes in ascending order."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - k + 1
    total = h[:n] * _MIX[0]
    for i in range(1, k):
        total += h[i : i + n] * _MIX[i % len(_MIX)]
    total ^= total >> np.uint64(32)  # low bits choose the sketch's bucket
    return np.unique(total)


def class_of(words: list[bytes]) -> tuple[int, int]:
    """The class of a word sequence: 128 bits of digest as two signed integers."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(b" ".join(words)))


def ceil_share(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def prefix_size(n: int, percent: int) -> int:
    return n - ceil_share(n, percent) + 1


class Order:
    """The global order: sketch level first, then the hash."""

    def __init__(self, levels: np.ndarray):
        self.levels = levels

    def keys(self, s: np.ndarray) -> np.ndarray:
        level = self.levels[(s & np.uint64(WIDTH - 1)).astype(np.int64)].astype(np.uint64)
        return (level << np.uint64(56)) | (s >> np.uint64(8))

    def sort(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.keys(s)
        at = np.lexsort((s, keys))
        return s[at], keys[at]


# ---------------------------------------------------------------- scans


def _classes(rows: int = 512):
    names = ["doc_id", "n", "hi", "lo", "chunk", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, room = np.zeros(WIDTH, np.int64), [], 0
        for big in batches:
            for at in range(0, big.num_rows, rows):
                batch = big.slice(at, rows)
                ns, keys = [], []
                for text in batch.column(1).to_pylist():
                    words = words_of(text)
                    s = shingles(words)
                    ns.append(len(s)), keys.append(class_of(words))
                    waiting.append((s & np.uint64(WIDTH - 1)).astype(np.int32))
                    room += len(s)
                if room > WIDTH:
                    counts += np.bincount(np.concatenate(waiting), minlength=WIDTH)
                    waiting, room = [], 0
                m, (hi, lo) = batch.num_rows, zip(*keys)
                yield pa.record_batch([batch.column(0), *(pa.array(x, pa.int64()) for x in (ns, hi, lo)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=WIDTH)
        if counts.any():
            parts = [zlib.compress(counts[a : a + CHUNK].astype("<u4").tobytes(), 1) for a in range(0, WIDTH, CHUNK)]
            m = len(parts)
            yield pa.record_batch([pa.nulls(m, big.column(0).type), *[pa.nulls(m, pa.int64())] * 3, pa.array(range(m), pa.int32()), pa.array(parts, pa.binary())], names=names)

    return run


def _sum_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for c, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = sums.setdefault(c, np.zeros(CHUNK, np.int64))
            own += np.frombuffer(zlib.decompress(data), "<u4")
    if sums:
        level = [np.minimum(255, np.round(6 * np.log2(1 + sums[c]))).astype(np.uint8).tobytes() for c in sums]
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(level, pa.binary())], names=["chunk", "counts"])


def _prefixes(order: Order, percent: int, rows: int = 256):
    """(token, hi, n, pos) of the first text of each class in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for big in batches:
            for at in range(0, big.num_rows, rows):
                columns = [[], [], [], []]
                for text in big.column(0).slice(at, rows).to_pylist():
                    words = words_of(text)
                    key = class_of(words)
                    if not words or key in seen:
                        continue
                    seen.add(key)
                    s = shingles(words)
                    p = prefix_size(len(s), percent)
                    for c, x in zip(columns, (order.sort(s)[0][:p].view(np.int64), np.full(p, key[0]), np.full(p, len(s), np.int64), np.arange(p, dtype=np.int32))):
                        c.append(x)
                if columns[0]:
                    yield pa.record_batch([pa.array(np.concatenate(x)) for x in columns], names=["token", "hi", "n", "pos"])

    return run


def _verify(order: Order, percent: int):
    """Keeps the pairs whose sets reach the share.  Rows (head, id, text), a head before the
    partners that it is held against.  A row's text that isn't of the row's class (ids may
    repeat with other texts) is passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in batches:
            us, vs = [], []
            for i, (is_head, c, text) in enumerate(zip(*(batch.column(name).to_pylist() for name in ("head", "id", "text")))):
                words = words_of(text)
                if class_of(words) != (c["hi"], c["lo"]):
                    continue
                found = order.sort(shingles(words))
                if is_head:
                    head, own = batch.column("id").slice(i, 1), found
                elif similar(own, found, percent):
                    us.append(head), vs.append(i)
            if vs:
                yield pa.record_batch([pa.concat_arrays(us), batch.column("id").take(pa.array(vs))], names=["u", "v"])

    return run


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], percent: int) -> bool:
    """Length, positional and suffix filter, then the exact overlap."""
    (sa, ka), (sb, kb) = a, b
    na, nb = len(sa), len(sb)
    if 100 * min(na, nb) < percent * max(na, nb):
        return False
    need = -(-percent * (na + nb) // (100 + percent))
    pa_, pb_ = sa[: prefix_size(na, percent)], sb[: prefix_size(nb, percent)]
    _, ia, ib = np.intersect1d(pa_, pb_, assume_unique=True, return_indices=True)
    if not len(ia):
        return False
    first = int(np.argmin(ia))
    i, j = int(ia[first]), int(ib[first])
    if min(na - i, nb - j) < need:  # nothing is shared before the first shared one
        return False
    # The middle of b's suffix halves both suffixes; sizes that differ can't match.
    ra, rb = ka[i + 1 :], kb[j + 1 :]
    if len(rb):
        w = rb[len(rb) // 2]
        la, lb = int(np.searchsorted(ra, w)), int(np.searchsorted(rb, w))
        apart = abs(la - lb) + abs((len(ra) - la) - (len(rb) - lb))
        if 1 + (len(ra) + len(rb) - apart) // 2 < need:
            return False
    both = len(np.intersect1d(sa, sb, assume_unique=True))
    return 100 * both >= percent * (na + nb - both)


# ---------------------------------------------------------------- the join


def _fits(percent: int):
    """Length filter on the classes a and b."""
    lo, hi = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    return 100 * lo >= percent * hi


def _places(percent: int):
    """Positional filter for a shared prefix shingle at the places pos_a and pos_b.

    As if it were the pair's first shared one, before which nothing is shared: a pair that
    is similar passes at its first one, so that failing at later ones loses nothing.
    """
    top = F.least(F.col("a.n") - F.col("pos_a"), F.col("b.n") - F.col("pos_b"))
    return top * (100 + percent) >= percent * (F.col("a.n") + F.col("b.n"))


class NgramJoin:
    """Classes are structs (rep, hi, lo, n): the least id of the class's rows, its digest, its
    set's size.  So the least class of a component holds the component's least id."""

    def __init__(self, docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text: str = "text"):
        self.percent = percent
        self.docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
        self.kind = docs.schema[id_col].dataType.simpleString()
        self.scratch = Scratch(docs.sparkSession, "ngramjoin")

    def _order(self, scanned: DataFrame) -> Order:
        parts = scanned.where(F.col("chunk").isNotNull()).select("chunk", "counts").repartition(WIDTH // CHUNK, "chunk").mapInArrow(giving_back(_sum_chunks), "chunk int, counts binary")
        levels = np.zeros(WIDTH, np.uint8)
        for row in parts.collect():  # WIDTH bytes, whatever the input's size
            levels[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(bytes(row["counts"]), np.uint8)
        return Order(levels)

    def _shared(self, prefix: DataFrame, reps: DataFrame) -> DataFrame:
        """Rows (token, id, pos, alone) of the shingles that stand in several prefixes.

        The wide rows of all prefixes hold half of the class's digest; ``_clashes`` pairs the
        classes that this half and their size can't tell apart.  ``alone``, the number of the
        class's prefix shingles that no other prefix has, chooses centres and filters
        nothing: such a shingle may stand in another class's set beyond its prefix.
        ``pos`` is the shingle's place in the class's order.
        """
        # One exchange, by shingle, for all that follows up to the classes' own facts.  Copies
        # in several tasks bring their class's rows again.
        rows = prefix.repartition("token").groupBy("token", "hi", "n").agg(F.min("pos").alias("pos"))
        rows = rows.withColumn("classes", F.count(F.lit(1)).over(W.partitionBy("token"))).where("classes > 1").drop("classes")
        rows = rows.join(reps.where("id.rep is not null").select("id.hi", "id.n", "id.lo", "id.rep"), ["hi", "n"])
        alone = F.col("n") - F.floor((self.percent * F.col("n") + 99) / 100) + 1 - F.count(F.lit(1)).over(W.partitionBy("hi", "n", "lo"))
        return rows.select("token", F.struct("rep", "hi", "lo", "n").alias("id"), "pos", alone.alias("alone"))

    def _clashes(self, reps: DataFrame) -> DataFrame:
        """Pairs (a, b) of classes with half of the digest and the size in common."""
        half = reps.where("id.rep is not null").select("id.hi", "id.n", "id.lo", "id")
        twice = half.groupBy("hi", "n").agg(F.min("lo").alias("least"), F.max("lo").alias("most")).where("least < most").select("hi", "n")
        some = self.scratch.write(half.join(twice, ["hi", "n"]), "clashes")
        other = some.select("hi", "n", F.col("lo").alias("lo_b"), F.col("id").alias("b"))
        return some.join(other, ["hi", "n"]).where("lo < lo_b").select(F.col("id").alias("a"), "b")

    def _centred(self, lists: DataFrame) -> DataFrame:
        """The rows with each shingle's centre: the class with the fewest shingles of its
        own, which among the copies of a text is the text that the others were made from."""
        least = F.min(F.struct("alone", "id")).over(W.partitionBy("token"))
        return lists.withColumn("centre", least["id"]).select("token", "id", "pos", "centre")

    def _check(self, pairs: DataFrame, order: Order, many_texts: bool) -> DataFrame:
        """Links (u, v) among the pairs (a, b).  A centre's partners are dealt in chunks.

        ``many_texts``: a good share of all texts is asked for, so that they are dealt by id
        at every size; else Spark may send the few ids to the texts.
        """
        many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS).alias("chunks")).where("chunks > 1")
        chunk = F.pmod(F.xxhash64("b"), F.coalesce("chunks", F.lit(1))).cast("int")
        pairs = pairs.join(many, "a", "left").select("a", "b", chunk.alias("part"))
        heads = pairs.select("a", "part").distinct().select("a", "part", F.lit(True).alias("head"), F.col("a").alias("id"))
        wanted = self.scratch.write(heads.unionByName(pairs.select("a", "part", F.lit(False).alias("head"), F.col("b").alias("id"))), "wanted")
        # Only the texts asked for are dealt out, each once for a chunk that needs it.
        ids = wanted.select(F.col("id.rep").alias("rep")).distinct()
        texts = self.docs.join(ids.hint("merge") if many_texts else ids, F.col("doc_id") == F.col("rep"), "left_semi").distinct()
        dealt = wanted.join(texts, F.col("id.rep") == F.col("doc_id")).select("a", "part", "head", "id", "text")
        dealt = dealt.repartition("a", "part").sortWithinPartitions("a", "part", F.col("head").desc())
        kind = pairs.schema["a"].dataType.simpleString()
        return self.scratch.write(dealt.select("head", "id", "text").mapInArrow(giving_back(_verify(order, self.percent)), f"u {kind}, v {kind}"), "links")

    def rows(self) -> DataFrame:
        """doc_id, n, hi, lo, id (the class) and component (its least class) of every row; class
        and component are null for rows without words."""
        put, percent = self.scratch.write, self.percent
        scanned = put(self.docs.mapInArrow(giving_back(_classes()), f"doc_id {self.kind}, n bigint, hi bigint, lo bigint, chunk int, counts binary"), "classes")
        order = self._order(scanned)
        rows = scanned.where(F.col("chunk").isNull()).select("doc_id", "n", "hi", "lo")
        reps = rows.where("n > 0").groupBy("hi", "lo", "n").agg(F.min("doc_id").alias("rep"))
        reps = put(reps.select(F.struct("rep", "hi", "lo", "n").alias("id")), "reps")
        prefix = put(self.docs.select("text").mapInArrow(giving_back(_prefixes(order, percent)), "token bigint, hi bigint, n bigint, pos int"), "prefix")
        shared = put(self._shared(prefix, reps), "lists")
        self.scratch.drop_df(prefix)
        lists = put(self._centred(shared), "kept")
        self.scratch.drop_df(shared)
        links = self._links(lists, reps, order)
        comp = components(links, self.scratch).withColumnRenamed("node", "id")
        found = reps.join(comp, "id", "left").select("id", F.coalesce("component", "id").alias("component"), F.col("id.hi").alias("hi"), F.col("id.lo").alias("lo"))
        return rows.join(found, ["hi", "lo"], "left").select("doc_id", F.col("n"), "hi", "lo", F.when(F.col("n") > 0, F.col("id")).alias("id"), F.when(F.col("n") > 0, F.col("component")).alias("component"))

    def run(self) -> DataFrame:
        """doc_id, n_shingles, component_id for every row."""
        return self.rows().select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component.rep", "doc_id").alias("component_id"))

    def _links(self, lists: DataFrame, reps: DataFrame, order: Order) -> DataFrame:
        put, percent = self.scratch.write, self.percent
        pairs = lists.where(F.col("id") != F.col("centre")).select(F.col("centre").alias("a"), F.col("id").alias("b"))
        tried = put(pairs.unionByName(self._clashes(reps)).where(_fits(percent)).distinct(), "pairs")
        links = self._check(tried, order, True)
        # What is one component by now needs no more pairs; a component is told by its least class's digest.
        comp = components(links, self.scratch).select(F.col("node").alias("id"), F.struct("component.hi", "component.lo").alias("comp"))
        now = lists.select("token", "id", "pos").join(comp, "id", "left").withColumn("comp", F.coalesce("comp", F.struct("id.hi", "id.lo")))
        left = put(self._open(now), "open")
        if left.isEmpty():
            return links
        done = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pairs = put(self._across(left).distinct().join(done, ["a", "b"], "left_anti"), "pairs")
        return links.unionByName(self._check(pairs, order, False))

    def _open(self, placed: DataFrame) -> DataFrame:
        """The rows (token, id, pos, comp) whose shingle stands in several components and that
        can still be half of a pair: ``indexed`` as the smaller set, or as the larger one with a
        smaller one's size from ``low`` to ``high``.

        Of two similar sets the smaller one, y, has their first shared shingle among its
        first y - need(y, y) + 1; the larger one, x, at a place that leaves need(x, y).
        """
        percent, n, pos, by_token = self.percent, F.col("id.n"), F.col("pos"), W.partitionBy("token")
        indexed = n - F.ceil(2 * percent * n / (100 + percent)) + 1 > pos
        room = F.floor((100 + percent) * (n - pos) / percent) - n
        told = placed.withColumn("indexed", indexed)
        size = F.when(F.col("indexed"), n)
        told = told.withColumns({"least": F.min("comp").over(by_token), "most": F.max("comp").over(by_token), "low": F.min(size).over(by_token), "high": F.max(size).over(by_token)})
        told = told.where(F.col("least") != F.col("most"))
        met = F.col("low").isNotNull()  # some set has the shingle where it is indexed
        told = told.withColumns({"low": F.when(met, F.greatest("low", F.ceil(percent * n / 100))), "high": F.when(met, F.least(F.col("high"), n, room))})
        probing = F.coalesce(F.col("low") <= F.col("high"), F.lit(False))
        return told.withColumn("probing", probing).where("indexed or probing").select("token", "id", "pos", "comp", "indexed", "probing", "low", "high")

    def _across(self, placed: DataFrame) -> DataFrame:
        """All pairs of classes of different components that share a prefix shingle and may
        be similar by their sizes and its places; ``a`` is the larger one."""
        band = lambda size: F.floor(F.log(size.cast("double")) * 10).cast("int")
        index = placed.where("indexed").select("token", band(F.col("id.n")).alias("band"), F.col("id").alias("b"), F.col("pos").alias("pos_b"), F.col("comp").alias("comp_b"))
        bands = F.sequence(band(F.col("low")), band(F.col("high")))
        probe = placed.where("probing").select("token", F.explode(bands).alias("band"), F.col("id").alias("a"), F.col("pos").alias("pos_a"), F.col("comp").alias("comp_a"))
        larger = F.struct("b.n", "b.hi", "b.lo") < F.struct("a.n", "a.hi", "a.lo")
        joined = probe.join(index, ["token", "band"]).where(larger & (F.col("comp_a") != F.col("comp_b")) & _fits(self.percent) & _places(self.percent))
        return joined.select("a", "b")


def _with_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hi, lo = zip(*map(class_of, map(words_of, batch.column(0).to_pylist()))) if batch.num_rows else ((), ())
        yield pa.record_batch([*batch.columns[1:], pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], names=[*batch.schema.names[1:], "class_hi", "class_lo"])


def ngram_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    return NgramJoin(docs, percent).run()


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the least id, with all columns.

    A document is known by its id and words: rows with one id and other words are documents
    of their own, rows alike in both are one and stay together.  Rows without an id stay.
    """
    join = NgramJoin(docs, percent)
    first = F.col("id").isNull() | ((F.col("id") == F.col("component")) & (F.col("doc_id") == F.col("component.rep")))
    rows = join.rows().where(F.col("doc_id").isNotNull()).select("doc_id", "hi", "lo", (~first).alias("gone"))
    by_id = rows.groupBy("doc_id").agg(F.min("gone").alias("all"), F.max("gone").alias("any"))
    gone = by_id.where("any").select(F.col("doc_id").alias("gone_id"), "all")
    partly = join.scratch.write(gone.where(~F.col("all")).select("gone_id"), "partly")
    out = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
    if partly.isEmpty():
        return out
    # Ids of which some texts stay: those rows are told apart by their words.
    mixed = docs.join(partly, docs["doc_id"] == partly["gone_id"], "left_semi")
    fields = ", ".join(f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(mixed.schema))
    named = mixed.select(F.col("text").alias("_t"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(mixed.columns)]).mapInArrow(giving_back(_with_class), f"{fields}, class_hi bigint, class_lo bigint")
    stay = rows.where(~F.col("gone")).select(F.col("doc_id").alias("stay"), "hi", "lo")
    at = f"c{docs.columns.index('doc_id')}"
    kept = named.join(stay, (F.col(at) == F.col("stay")) & (F.col("class_hi") == F.col("hi")) & (F.col("class_lo") == F.col("lo")), "left_semi")
    return out.unionByName(kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]))
