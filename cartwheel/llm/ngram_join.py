"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters, exact verification.

Documents with the same shingle set are one class from the start.  Every 5-word shingle travels once to the
task that owns its hash range (sorted, delta-coded, several thousand documents to a row), which counts in how many classes
it occurs.  A shingle of one class can link nothing, so only the others go on to the task that owns the class.  There a
class orders its shingles rare first; if those that occur elsewhere cannot reach 75 % of its set it is alone, else
its first ``n - ceil(0.75 n) + 1`` shingles are the prefix, of which the shared ones are posted.

Two classes that share a prefix shingle are candidates if their sizes (length filter) and the shingle's positions
(positional filter) allow the similarity.  Classes are first compared with one or two pivots of each posting list,
links make components; in ``ROUNDS`` further rounds the classes of lists that still hold several components are
compared with ``DRAWS`` members of each list, drawn by hash; and then *every* remaining candidate pair of different components is examined, once.  A pair must pass
a bound on the symmetric difference of the sets (parity bitmaps) and of the parts between probing
shingles (suffix filter) before the sets are intersected.  Pairs within a component need no look, so a group of
near copies costs about one comparison per document, not one per pair, and no link between components is missed.

Document frequencies are exact up to ``cap``; a shingle that ``cap`` classes of one task share is known to be
common there and sends one marker instead of its rows, so no shingle floods a task.

Defined results: a null or empty text or one without words has an empty set, links with nothing and is its own component;
fewer than five words make one shingle of the whole sequence; repeated rows and ids fall together; a null id
gets a component only through a link; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm import bitmap
from cartwheel.llm.blocks import U, Words, as_int64, give_back, mix, pack, shingles, text_blocks, unpack
from cartwheel.llm.components import connected_components, settled, tasks_for

SHINGLE_BITS = 56
CAP = 256
ROUNDS, DRAWS = 4, 4
FLUSH = 1_000_000        # shingles a task holds before it sends them
PAIRS_A_TASK = 50_000
BUCKET = 1_200_000       # shingles a receiving task gets, about

# A class is named by a 64-bit reference on its way: if several documents have its set, by its fingerprint (highest bit
# set), else by the flush that sent it and its place there, which costs two bytes an entry instead of a fingerprint a row.
_PRINT = U(1 << 63)
PLACE_BITS = 16
ENTRIES, COMMON, DIRECTORY = 0, 1, 2


def set_print(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Fingerprint of every set: 63 bits of hash below a set highest bit."""
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(sets ^ U(0xA5A5A5A55A5A5A5A)), dtype=np.uint64)))
    return mix(run[off[1:]] - run[off[:-1]] + np.diff(off).astype(np.uint64)) | _PRINT


def document_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5) -> DataFrame:
    """(doc_id, n_shingles, fp): size and fingerprint of every document's shingle set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, off in text_blocks(batches):
            sets, edge = shingles(Words(raw, off), n)
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.diff(edge)), pa.array(set_print(sets, edge).view(np.int64))], ["doc_id", "n_shingles", "fp"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, n_shingles bigint, fp bigint")


def _planes(delta: np.ndarray) -> np.ndarray:
    """Bytes of 64-bit values, plane by plane (the high planes of small values compress to nothing)."""
    return np.ascontiguousarray(delta.view(np.uint8).reshape(-1, 8).T).ravel()


def _unplanes(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(np.uint64)


def flush_number(task: int, k: int) -> int:
    return (task << PLACE_BITS) + k


def _encode_sent(shingle: np.ndarray, who: np.ndarray, number: int, copied: np.ndarray, fp: np.ndarray, size: np.ndarray, df: np.ndarray) -> bytes:
    """Entries of one flush, sorted by shingle; ``who``: places of their classes; fingerprint and size of ``copied`` ones only."""
    used = np.unique(who[copied[who]])
    places = who.astype(np.uint16).view(np.uint8).reshape(len(who), 2).T.ravel()
    return pack([_planes(np.diff(shingle, prepend=U(0))), places, df, np.array([number], np.int64), used.astype(np.uint16), fp[used], size[used].astype(np.uint32)])


def _decode_sent(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, reference, size, df) of every entry; the size of a class named by its place is 0."""
    planes, places, df, number, used, fp, size = unpack(blob)
    who = np.ascontiguousarray(places.reshape(2, -1).T).reshape(-1).view(np.uint16).astype(np.int64)
    ref = (U(int(number[0])) << U(PLACE_BITS)) | who.astype(np.uint64)
    sizes = np.zeros(len(who), np.uint32)
    if len(used):
        at = np.minimum(np.searchsorted(used, who), len(used) - 1)
        hit = used[at] == who
        ref[hit], sizes[hit] = fp[at[hit]], size[at[hit]]
    return np.cumsum(_unplanes(planes), dtype=np.uint64), ref, sizes, df


def _encode(shingle: np.ndarray, who: np.ndarray, refs: np.ndarray, size: np.ndarray, df: np.ndarray) -> bytes:
    """Entries sorted by shingle; ``who`` numbers the classes (reference, size) of this row, in order of reference."""
    kind = np.uint16 if len(refs) <= 1 << 16 else np.uint32
    return pack([_planes(np.diff(shingle, prepend=U(0))), who.astype(kind).view(np.uint8).reshape(len(who), -1).T.ravel(), np.array([np.dtype(kind).itemsize], np.uint8), df,
                 _planes(np.diff(refs, prepend=U(0))), _planes(size.astype(np.uint64))])


def _decode(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, reference, size, df) of every entry."""
    planes, who, width, df, refs, size = unpack(blob)
    w = int(width[0])
    who = np.ascontiguousarray(who.reshape(w, -1).T).reshape(-1).view(np.uint16 if w == 2 else np.uint32)
    return np.cumsum(_unplanes(planes), dtype=np.uint64), np.cumsum(_unplanes(refs), dtype=np.uint64)[who], _unplanes(size)[who].astype(np.uint32), df


def class_bucket(ref: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where a class is looked after: by its fingerprint, or by the flush that holds its directory entry."""
    by_flush = mix((ref >> U(PLACE_BITS)) + U(0x51ED27)) % U(n_buckets)
    return np.where(ref >= _PRINT, ref % U(n_buckets), by_flush).astype(np.int64)


def _to_classes(shingle, ref, size, df, n_buckets: int) -> Iterator[tuple[int, bytes]]:
    """Rows (bucket of the class, payload)."""
    bucket = class_bucket(ref, n_buckets)
    order = np.lexsort((shingle, bucket))
    shingle, ref, size, df, bucket = shingle[order], ref[order], size[order], df[order], bucket[order]
    edge = np.searchsorted(bucket, np.arange(n_buckets + 1))
    for b in range(n_buckets):
        lo, hi = edge[b], edge[b + 1]
        if hi > lo:
            u, first, who = np.unique(ref[lo:hi], return_index=True, return_inverse=True)
            yield b, _encode(shingle[lo:hi], who, u, size[lo:hi][first], df[lo:hi])


def copied_sets(sets: DataFrame):
    """(broadcast, bits): a bitmap of bounded size of the fingerprints that several rows of ``sets`` have.

    A false hit only makes a class travel by its fingerprint.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([(as_int64(batch.column(0)).view(np.uint64) << U(1)).tobytes()], pa.binary())], ["payload"])

    several = sets.where("n_shingles > 0").groupBy("fp").agg(F.count("*").alias("k")).where("k > 1").select("fp").checkpoint()
    bits = bitmap.bits_for(several.count())
    return sets.sparkSession.sparkContext.broadcast(bitmap.union(several.mapInArrow(packed, "payload binary"), bits)), bits


def shared_shingles(docs: DataFrame, n_shingles: int, copied: tuple, id_col: str = "doc_id", text_col: str = "text", n: int = 5, cap: int = CAP) -> DataFrame:
    """(kind, bucket, payload): the shingles that occur in two classes or more, dealt by class, and the flushes' directories."""
    n_buckets = max(1, -(-n_shingles // BUCKET))
    copies, bits = copied

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count, n_classes, flushes, seen = 0, 0, 0, np.zeros(0, np.uint64)
        task = TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            sets = np.concatenate([h[0] for h in held])
            size = np.concatenate([h[1] for h in held])
            fp = np.concatenate([h[2] for h in held])
            number = flush_number(task, flushes)
            several = bitmap.has(copies.value, fp << U(1), bits)
            ref = np.where(several, fp, (U(number) << U(PLACE_BITS)) | np.arange(len(fp), dtype=np.uint64))
            who = np.repeat(np.arange(len(size)), size)
            order = np.argsort(sets, kind="stable")
            sets, who = sets[order], who[order]
            new = np.ones(len(sets), bool)
            new[1:] = sets[1:] != sets[:-1]
            start = np.flatnonzero(new)
            times = np.diff(np.append(start, len(sets)))
            common = np.repeat(times >= cap, times)
            home = int(class_bucket(np.array([number], np.uint64) << U(PLACE_BITS), n_buckets)[0])
            rows = [(DIRECTORY, home, pack([np.array([number], np.int64), np.where(several, U(0), fp), size.astype(np.uint32)]))]
            if common.any():
                at = np.flatnonzero(common)
                rows += [(COMMON, *x) for x in _to_classes(sets[at], ref[who[at]], np.where(several, size, 0)[who[at]], np.full(len(at), cap, np.uint16), n_buckets)]
            # entries of the others, and of a common shingle its first one as a marker with df = cap
            keep = ~common | new
            weight = np.where(common, cap, 1).astype(np.uint16)[keep]
            sets, who = sets[keep], who[keep]
            edge = np.searchsorted(sets >> U(24), (np.arange(n_buckets + 1, dtype=np.float64) / n_buckets * (1 << (SHINGLE_BITS - 24))).astype(np.uint64))
            rows += [(ENTRIES, b, _encode_sent(sets[edge[b]:edge[b + 1]], who[edge[b]:edge[b + 1]], number, several, fp, size, weight[edge[b]:edge[b + 1]]))
                     for b in range(n_buckets) if edge[b + 1] > edge[b]]
            for lo in range(0, len(rows), 16):
                part = list(zip(*rows[lo:lo + 16], strict=True))
                yield pa.record_batch([pa.array(part[0], pa.int32()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.binary())], ["kind", "bucket", "payload"])

        for _, raw, off in text_blocks(batches):
            sets, edge = shingles(Words(raw, off), n)
            fp, size = set_print(sets, edge), np.diff(edge)
            _, first = np.unique(fp, return_index=True)
            fresh = np.zeros(len(fp), bool)
            fresh[first] = True
            fresh &= ~np.isin(fp, seen) & (size > 0)  # a class once per task
            seen = np.union1d(seen, fp[fresh])
            new_sets, new_size, new_fp = sets[np.repeat(fresh, size)] >> U(64 - SHINGLE_BITS), size[fresh], fp[fresh]
            at, off_new = 0, np.concatenate(([0], np.cumsum(new_size)))
            while at < len(new_size):   # a flush has so many shingles, and fewer classes than places
                end = min(len(new_size), at + (1 << PLACE_BITS) - n_classes)
                held.append((new_sets[off_new[at]:off_new[end]], new_size[at:end], new_fp[at:end]))
                count, n_classes, at = count + int(off_new[end] - off_new[at]), n_classes + end - at, end
                if count >= FLUSH or n_classes >= 1 << PLACE_BITS:
                    yield from flush()
                    held, count, n_classes, flushes = [], 0, 0, flushes + 1
                    give_back()
        if count:
            yield from flush()
        held.clear()
        give_back()

    def owned(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if key[0] != ENTRIES:  # known to be common, or names of classes: go on as they are
            return group[["kind", "bucket", "payload"]]
        parts = [_decode_sent(p) for p in group["payload"]]
        shingle, ref, size, df = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        order = np.argsort(shingle, kind="stable")
        shingle, ref, size, df = shingle[order], ref[order], size[order], df[order]
        new = np.ones(len(shingle), bool)
        new[1:] = shingle[1:] != shingle[:-1]
        group_no = np.cumsum(new) - 1
        many = (np.bincount(group_no) > 1)[group_no] | (df >= cap)
        shingle, ref, size, df, group_no = shingle[many], ref[many], size[many], df[many], group_no[many]
        order = np.lexsort((df, ref, group_no))
        shingle, ref, size, df, group_no = shingle[order], ref[order], size[order], df[order], group_no[order]
        once = np.ones(len(shingle), bool)
        once[1:] = (group_no[1:] != group_no[:-1]) | (ref[1:] != ref[:-1])
        _, group_no = np.unique(group_no, return_inverse=True)
        n_groups = int(group_no[-1]) + 1 if len(group_no) else 0
        total = np.minimum(np.bincount(group_no[once], minlength=n_groups), cap)
        total[group_no[df >= cap]] = cap  # any marker, also one whose class came from another task with df = 1
        total = total.astype(np.uint16)
        keep = once & (df < cap) & (total[group_no] >= 2)  # markers have sent their rows already
        rows = list(_to_classes(shingle[keep], ref[keep], size[keep], total[group_no[keep]], n_buckets))
        give_back()
        return pd.DataFrame({"kind": pd.Series([COMMON] * len(rows), dtype="int32"), "bucket": pd.Series([r[0] for r in rows], dtype="int64"), "payload": [r[1] for r in rows]})

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select("text")
    shape = "kind int, bucket bigint, payload binary"
    return rows.mapInArrow(send, shape).groupBy("kind", "bucket").applyInPandas(owned, shape)


def named(ref: np.ndarray, size: np.ndarray, directories: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, size) of references, those by place from their flush's directory."""
    told = sorted((unpack(b) for b in directories), key=lambda p: int(p[0][0]))
    number = np.array([int(p[0][0]) for p in told], np.uint64)
    start = np.concatenate(([0], np.cumsum([len(p[1]) for p in told]))).astype(np.int64)
    fp, sizes = ref.copy(), size.astype(np.int64)
    at = np.flatnonzero(ref < _PRINT)
    if len(at):
        every, how_many = (np.concatenate([p[k] for p in told]) for k in (1, 2))
        place = start[np.searchsorted(number, ref[at] >> U(PLACE_BITS))] + (ref[at] & U((1 << PLACE_BITS) - 1)).astype(np.int64)
        fp[at], sizes[at] = every[place], how_many[place]
    return fp, sizes


def prefix_length(n):
    """Shingles of a set of n of which a partner with 3/4 similarity must share one."""
    return n - (3 * n + 3) // 4 + 1


def parity_bits(tokens: np.ndarray) -> bytes:
    """Parity of the tokens in each of 2**k >= len(tokens) cells (64 at least)."""
    cells = 64
    while cells < len(tokens):
        cells *= 2
    return np.packbits(np.bincount((mix(tokens) & U(cells - 1)).astype(np.int64), minlength=cells).astype(np.uint8) & 1, bitorder="little").tobytes()


def parity_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets from their parity bits."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def suffix_bound(x: np.ndarray, y: np.ndarray, probes: int = 16) -> int:
    """Upper bound of the overlap of two sorted sets, from the sizes of the parts between probing tokens of x."""
    if not len(x) or not len(y):
        return 0
    at = np.unique(np.linspace(0, len(x), probes + 1).astype(np.int64))[1:-1]
    cut = np.searchsorted(y, x[at])
    return int(np.minimum(np.diff(at, prepend=0, append=len(x)), np.diff(cut, prepend=0, append=len(y))).sum())


CLASS = "fp bigint, n bigint, tokens binary, bits binary, prefix array<bigint>, first_pos bigint"


def candidate_classes(shared: DataFrame) -> DataFrame:
    """(fp, n, tokens, bits, prefix, first_pos) of the classes that may have a partner.

    ``tokens``: shared shingles, sorted; ``prefix``: those of the prefix, rare first, the first at ``first_pos``.
    """
    def told(cols: list) -> pd.DataFrame:
        kinds = {"fp": "int64", "n": "int64", "tokens": "object", "bits": "object", "prefix": "object", "first_pos": "int64"}
        return pd.DataFrame({name: pd.Series(list(c), dtype=kind) for (name, kind), c in zip(kinds.items(), cols, strict=True)})

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        parts = [_decode(p) for p in group["payload"][group["kind"] != DIRECTORY]]
        if not parts:
            return told([[]] * 6)
        shingle, ref, size, df = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        fp, size = named(ref, size, list(group["payload"][group["kind"] == DIRECTORY]))
        order = np.lexsort((shingle, fp))
        shingle, fp, size, df = shingle[order], fp[order], size[order], df[order]
        once = np.ones(len(fp), bool)  # copies of a class in several tasks send the same rows
        once[1:] = (fp[1:] != fp[:-1]) | (shingle[1:] != shingle[:-1])
        shingle, fp, size, df = shingle[once], fp[once], size[once], df[once]
        order = np.lexsort((shingle, df, fp))
        shingle, fp, size = shingle[order], fp[order], size[order]
        start = np.flatnonzero(np.concatenate(([True], fp[1:] != fp[:-1])))
        end = np.append(start[1:], len(fp))
        rows = []
        for s, e in zip(start, end, strict=True):
            n = int(size[s])
            alone = n - (e - s)
            k = prefix_length(n) - alone
            if k > 0:
                tokens = np.sort(shingle[s:e])
                rows.append((int(fp[s].view(np.int64)), n, tokens.tobytes(), parity_bits(tokens), shingle[s:s + k].astype(np.int64), alone))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        give_back()
        return told(cols)

    return shared.groupBy("bucket").applyInPandas(run, CLASS)


def verify(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of the pairs (a, b) of classes those with 100 * intersection >= 75 * union."""
    side = {s: classes.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("tokens").alias(f"t_{s}"), F.col("bits").alias(f"b_{s}")) for s in ("a", "b")}

    def rough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = zip(batch.column("b_a").to_pylist(), batch.column("b_b").to_pylist(), strict=True)
            apart = np.array([parity_difference(x, y) for x, y in bits], np.int64)
            n = as_int64(batch.column("r_a")) + as_int64(batch.column("r_b"))
            total = as_int64(batch.column("n_a")) + as_int64(batch.column("n_b"))
            ok = 7 * ((n - apart) // 2) >= 3 * total
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y, nx, ny in zip(*(batch.column(c).to_pylist() for c in ("t_a", "t_b", "n_a", "n_b")), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                need = -(-3 * (nx + ny) // 7)
                ok.append(suffix_bound(x, y) >= need and len(np.intersect1d(x, y, assume_unique=True)) >= need)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    small = {s: side[s].select(s, f"n_{s}", F.expr(f"octet_length(t_{s}) div 8").alias(f"r_{s}"), f"b_{s}") for s in side}
    near = pairs.join(small["a"], "a").join(small["b"], "b").mapInArrow(rough, "a bigint, b bigint")
    full = {s: side[s].select(s, f"n_{s}", f"t_{s}") for s in side}
    return near.join(full["a"], "a").join(full["b"], "b").mapInArrow(exact, "a bigint, b bigint")


def _passes(x: str, y: str) -> str:
    """Length and positional filter of two postings."""
    return (f"4 * least({x}.n, {y}.n) >= 3 * greatest({x}.n, {y}.n) and "
            f"7 * (1 + least({x}.n - {x}.pos - 1, {y}.n - {y}.pos - 1)) >= 3 * ({x}.n + {y}.n)")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cap: int = CAP) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    sets = document_sets(docs, id_col, text_col).checkpoint()
    members = sets.where("n_shingles > 0").groupBy("fp", "n_shingles").agg(F.min("doc_id").alias("rep"))
    n_shingles = sets.agg(F.sum("n_shingles")).first()[0] or 0
    alone = F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep", "doc_id")).otherwise(F.col("doc_id"))
    if not n_shingles:
        return sets.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    classes = settled(candidate_classes(shared_shingles(docs, n_shingles, copied_sets(sets), id_col, text_col, cap=cap))
                      .join(members.withColumnRenamed("n_shingles", "n"), ["fp", "n"]).where("rep is not null").drop("fp"), tasks_for(n_shingles, 8_000_000))
    size = classes.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0)).alias("p")).first()
    # small tables keep few files: the rounds below cost tasks by their rows
    postings_k, pairs_k = tasks_for(size["p"]), tasks_for(size["p"], PAIRS_A_TASK)
    postings = settled(classes.select("rep", "n", "first_pos", F.posexplode("prefix").alias("i", "token"))
                       .select("token", "rep", "n", (F.col("first_pos") + F.col("i")).alias("pos")), postings_k)

    # pivots: of every list and size class (a quarter apart) the smallest set, and one by hash
    sized = postings.withColumn("size", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4.0 / 3))))
    me = F.struct("rep", "n", "pos")
    pivots = (sized.groupBy("token", "size").agg(F.min(F.struct("n", "rep", "pos")).alias("p"), F.min(F.struct(F.xxhash64("rep").alias("h"), "rep", "n", "pos")).alias("q"), F.count(F.lit(1)).alias("k"))
              .where("k > 1").drop("k"))
    stars = sized.join(pivots, ["token", "size"]).select(me.alias("x"), F.explode(F.array(F.struct("p.rep", "p.n", "p.pos"), F.struct("q.rep", "q.n", "q.pos"))).alias("y"))
    ordered = [F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")]
    tried = settled(stars.where(_passes("x", "y")).where("x.rep <> y.rep").select(*ordered).distinct(), pairs_k)
    links = settled(verify(tried, classes), pairs_k)
    labels = connected_components(links)

    def open_lists() -> DataFrame:
        """Postings with their component, of the lists that hold several."""
        told = sized.join(labels, sized["rep"] == labels["node"], "left").select("token", "size", "rep", "n", "pos", F.coalesce("component", "rep").alias("component"))
        mixed = told.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("token")
        return settled(told.join(mixed, "token"), postings_k)

    for k in range(ROUNDS):  # pairs of different components with some drawn members of each list
        lists = open_lists()
        seeds = [F.min(F.struct(F.xxhash64("rep", "token", F.lit(DRAWS * k + j)).alias("h"), "rep", "n", "pos", "component")).alias(f"y{j}") for j in range(DRAWS)]
        drawn = lists.groupBy("token").agg(*seeds).select("token", F.explode(F.array(*[f"y{j}" for j in range(DRAWS)])).alias("y"))
        pairs = settled(lists.select("token", F.struct("rep", "n", "pos", "component").alias("x")).join(drawn, "token").where("x.component <> y.component")
                        .where(_passes("x", "y")).select(*ordered).distinct().join(tried, ["a", "b"], "left_anti"), pairs_k)
        links = settled(verify(pairs, classes), pairs_k)
        if not links.limit(1).count():
            break
        tried = tried.unionByName(pairs)
        labels = connected_components(links, start=labels)

    # whatever is left between different components
    lists = open_lists()
    rest = settled(lists.alias("x").join(lists.alias("y"), "token").where("x.component < y.component").where(_passes("x", "y"))
                   .select(*ordered).distinct().join(tried, ["a", "b"], "left_anti"), pairs_k)
    more = settled(verify(rest, classes), pairs_k)
    labels = connected_components(more, start=labels) if more.limit(1).count() else labels
    found = members.join(labels, members["rep"] == labels["node"], "left").select("fp", "n_shingles", "rep", "component")
    return sets.join(found, ["fp", "n_shingles"], "left").select("doc_id", "n_shingles", alone.alias("component_id"))
