"""Windows that occur again, over texts seen as sequences of units.

A unit is a byte or a word. Every window of ``width`` units contains an anchor
that depends on nothing but the window, so equal windows share an anchor at the
same place. The work then is on anchors instead of positions:

1. each anchor gets a bucket, the name of its own units, and the name of its
   context, all units that a window holding it can reach. Equal contexts that meet
   in one task are settled there;
2. sorting a bucket by context names refines it into classes of equal context.
   In a class all but the first occurrence are repeats as a whole. Buckets of one
   class need nothing more;
3. in a bucket of several classes the first occurrences are compared by the names
   of their windows. A bucket of more than ``CROWD`` such rows is not held by one
   task: its windows become rows that Spark groups by name.

A bucket that holds more than a share ``HOT`` of the anchors of a task, counted with
``SMALL`` more, is not gathered at all. The task sends it a mark, and its rows elsewhere,
each on its own, to have their windows grouped by name; the mark lets the rows of other
tasks follow.

Names are 64-bit and built by doubling: the name of 2k units at p comes from the
names of k units at p and at p + k.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridestrata.operators.stored import lookup_join, store

CROWD = 20_000
HOT = 0.001
SMALL = 32_000
BLOCK = 1 << 16
TOGETHER = 500_000
SPAN = "doc_id long, start int, stop int"
MARK = 1 << 63  #: context of marks and of rows of hot buckets: first in the order
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of a pair of names; the order counts."""
    x = a * _A
    x ^= x >> np.uint64(32)
    x += b
    x *= _B
    x ^= x >> np.uint64(29)
    x *= _C
    x ^= x >> np.uint64(32)
    return x


def later(values: np.ndarray, by: int) -> np.ndarray:
    """Values ``by`` places on, zero beyond the end."""
    moved = np.zeros_like(values)
    if by < len(values):
        moved[: len(values) - by] = values[by:]
    return moved


def deepen(names: np.ndarray, have: int, want: int) -> np.ndarray:
    """Names of ``want`` units at each place from names of ``have`` units."""
    while 2 * have <= want:
        names = name(names, later(names, have))
        have *= 2
    return name(names, later(names, want - have)) if have < want else names


@dataclass(frozen=True)
class Units:
    """How a kind of text is cut into units.

    ``cut`` gives the units of a text as an array of unsigned integers, ``pad`` a
    unit that no text has, ``first`` the names at the smallest depth and that
    depth, ``anchors`` the anchors of an array of padded texts: start, size, name."""

    width: int
    dtype: str
    pad: int
    cut: Callable[[bytes], np.ndarray]
    first: Callable[[np.ndarray], tuple[np.ndarray, int]]
    anchors: Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]]

    def windows(self, array: np.ndarray, other: bool = False) -> np.ndarray:
        """The name of the window at each place, or another one that is independent of it."""
        names, depth = self.first(array)
        if other:
            names = name(names, np.ones(1, dtype=np.uint64))
        return deepen(names, depth, self.width)

    def inside(self, array: np.ndarray) -> np.ndarray:
        """Where a window starts that holds no padding."""
        pads = np.concatenate([[0], np.cumsum(array == self.pad, dtype=np.int64)])
        ok = np.zeros(len(array), dtype=bool)
        n = len(array) - self.width + 1
        if n > 0:
            ok[:n] = pads[self.width :][:n] == pads[:n]
        return ok

    def padded(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Texts in one array with ``width`` pads around each; where each starts."""
        gap = np.full(self.width, self.pad, dtype=self.dtype)
        parts = [gap]
        for text in texts:
            parts += [text, gap]
        sizes = np.array([len(text) + self.width for text in texts], dtype=np.int64)
        return np.concatenate(parts), np.cumsum(sizes) - sizes + self.width


def _blocks(batch: pa.RecordBatch, units: Units) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Ids and unit arrays of texts, some ``BLOCK`` units at a time."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
        cut = units.cut(text.as_py() or b"")
        if len(cut) < units.width:
            continue
        ids.append(doc_id)
        texts.append(cut)
        size += len(cut)
        if size >= BLOCK:
            yield np.array(ids, dtype=np.int64), texts
            ids, texts, size = [], [], 0
    if ids:
        yield np.array(ids, dtype=np.int64), texts


def _own_bucket(doc_id: np.ndarray, at: np.ndarray) -> np.ndarray:
    return name(doc_id.astype(np.uint64), at.astype(np.uint64))


def _settled(bucket, context, doc_id, at, size, within: bool, hot: float):
    """Rows of one task with those marked, by a negative size, that repeat another
    of its rows as a whole. They are decided, so they need not meet their bucket:
    they get a bucket of their own. A passage that very many texts share thus sends
    one row per task to its bucket. The open rows of a hot bucket get buckets of their
    own too, and the context ``MARK``; a row of size zero marks the bucket."""
    if not len(bucket):
        return bucket, context, doc_id, at, size
    key = name(bucket, context)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    order = order[np.r_[same, False] | np.r_[False, same]]
    if len(order):
        order = order[np.lexsort((at[order], doc_id[order], key[order]))]
        head = np.r_[True, key[order][1:] != key[order][:-1]]
        lead = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
        repeat = doc_id[order] != doc_id[lead]
        if within:
            repeat |= ~head
        again = order[repeat]
        size[again] *= -1
        bucket[again] = _own_bucket(doc_id[again], at[again])
    context[context == MARK] += np.uint64(1)
    open_ = np.flatnonzero(size > 0)
    some = np.sort(bucket[open_])
    limit = int(hot * (len(bucket) + SMALL))
    marks = np.unique(some[limit:][some[limit:] == some[: len(some) - limit]]) if limit < len(some) else some[:0]
    if not len(marks):
        return bucket, context, doc_id, at, size
    loose = open_[np.isin(bucket[open_], marks)]
    bucket[loose], context[loose] = _own_bucket(doc_id[loose], at[loose]), MARK
    first = np.full(len(marks), np.iinfo(np.int64).min)
    none = np.zeros(len(marks), dtype=np.int64)
    added = (marks, np.full(len(marks), MARK, dtype=np.uint64), first, none, none)
    return tuple(map(np.concatenate, zip((bucket, context, doc_id, at, size), added)))


def _anchors(docs: DataFrame, units: Units, within: bool, hot: float) -> DataFrame:
    names = ["bucket", "context", "doc_id", "at", "size"]

    def rows_of(ids: np.ndarray, texts: list[np.ndarray]) -> list[np.ndarray]:
        array, starts = units.padded(texts)
        windows = units.windows(array)
        at, size, bucket = units.anchors(array, units.inside(array), units.width)
        context = name(windows[at + size - units.width], windows[at])
        text = np.searchsorted(starts, at, side="right") - 1
        return [bucket, context, ids[text], at - starts[text], size]

    def given(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        bucket, context, doc_id, at, size = _settled(*map(np.concatenate, zip(*parts)), within, hot)
        columns = [bucket.view(np.int64), context.view(np.int64), doc_id, at.astype(np.int32), size.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in rows:
            for ids, texts in _blocks(batch, units):
                parts.append(rows_of(ids, texts))
                if sum(len(part[0]) for part in parts) >= TOGETHER:
                    yield given(parts)
                    parts = []
        if parts:
            yield given(parts)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        batches, "bucket long, context long, doc_id long, at int, size int"
    )


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [column.to_numpy(zero_copy_only=False) for column in batch.columns]


def _classes(anchors: DataFrame, within: bool) -> DataFrame:
    """(bucket, doc_id, at, size): repeats as a whole have no bucket; the other rows
    are first occurrences in buckets of several classes, with a negative size and a
    bucket of their own where the bucket is hot. A mark counts as a class."""

    def row_batch(bucket, has, rows, hot=False):
        doc_id, at, size = rows
        hot = np.broadcast_to(hot, size.shape) & has
        bucket = np.where(hot, _own_bucket(doc_id, at).view(np.int64), bucket)
        real = size > 0
        bucket, has, doc_id, at, size = (x[real] for x in (bucket, has, doc_id, at, np.where(hot, -size, size)))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket, mask=~has), pa.array(doc_id), pa.array(at), pa.array(size)],
            ["bucket", "doc_id", "at", "size"],
        )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the bucket that a batch ends in: its last class and the least id there,
        # whether it has several classes, and first occurrences not yet given out.
        last = None
        several, pending, is_hot = False, None, False
        for part in parts:
            if not part.num_rows:
                continue
            bucket, context, doc_id, at, size = _columns(part)
            settled = size < 0
            if settled.any():
                yield row_batch(bucket[settled], ~settled[settled], [doc_id[settled], at[settled], -size[settled]])
                bucket, context, doc_id, at, size = (x[~settled] for x in (bucket, context, doc_id, at, size))
            loose = (context == -MARK) & (size > 0)
            if loose.any():
                yield row_batch(bucket[loose], loose[loose], [x[loose] for x in (doc_id, at, size)], True)
                bucket, context, doc_id, at, size = (x[~loose] for x in (bucket, context, doc_id, at, size))
            n = len(bucket)
            if not n:
                continue
            new_bucket = np.r_[last is None or bucket[0] != last[0], bucket[1:] != bucket[:-1]]
            new_class = new_bucket | np.r_[last is None or context[0] != last[1], context[1:] != context[:-1]]
            if new_bucket[0]:
                several, pending, is_hot = False, None, False
            number = np.cumsum(new_class)  # 0: the class that goes on from before
            least = np.concatenate([[last[2] if last else 0], doc_id[new_class]])[number]
            repeat = ~new_class if within else doc_id != least
            group = np.cumsum(new_bucket)  # 0: the bucket that goes on
            many = np.zeros(group[-1] + 1, dtype=bool)
            many[group[new_class & ~new_bucket]] = True
            many[0] |= several
            hot = np.zeros(group[-1] + 1, dtype=bool)
            hot[group[size == 0]] = True
            hot[0] |= is_hot
            first = ~repeat
            if pending is not None and many[0]:
                yield row_batch(*pending)
                pending = None
            out = repeat | (first & many[group])
            if out.any():
                yield row_batch(bucket[out], first[out], [x[out] for x in (doc_id, at, size)], hot[group[out]])
            held = first & ~many[group] & (group == group[-1])
            if held.any():
                now = (bucket[held], first[held], [x[held] for x in (doc_id, at, size)])
                if pending is not None and group[-1] == 0:
                    now = (
                        np.concatenate([pending[0], now[0]]),
                        np.concatenate([pending[1], now[1]]),
                        [np.concatenate(pair) for pair in zip(pending[2], now[2])],
                    )
                pending = now
            elif group[-1] > 0:
                pending = None
            several, is_hot = bool(many[group[-1]]), bool(hot[group[-1]])
            last = (bucket[n - 1], context[n - 1], least[n - 1])

    return (
        anchors.repartition("bucket")
        .sortWithinPartitions("bucket", "context", "doc_id", "at")
        .mapInArrow(batches, "bucket long, doc_id long, at int, size int")
    )


def _contexts(docs: DataFrame, firsts: DataFrame, units: Units) -> DataFrame:
    """(bucket, doc_id, start, units, loose): the units that windows around an anchor
    reach, padding included, and the place of the first of them; whether the bucket was
    hot."""
    per_doc = firsts.groupBy("doc_id").agg(F.collect_list(F.struct("bucket", "at", "size")).alias("found"))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(per_doc, "doc_id")

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = batch["found"]
            lists, values = found.offsets.to_numpy(), found.values
            bucket, at, size = (values.field(i).to_numpy() for i in range(3))
            for part in range(batch.num_rows):
                lo, hi = lists[part], lists[part + 1]
                cut = units.cut(batch["text"][part].as_py())
                array, starts = units.padded([cut])
                sizes = np.abs(size[lo:hi].astype(np.int64))
                start = at[lo:hi].astype(np.int64) + sizes - units.width
                length = 2 * units.width - sizes
                step = array.itemsize
                whole = array.tobytes()
                begins = ((start + starts[0]) * step).tolist()
                ends = ((start + starts[0] + length) * step).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[lo:hi]),
                        pa.array(np.full(hi - lo, batch["doc_id"][part].as_py(), dtype=np.int64)),
                        pa.array(start.astype(np.int32)),
                        pa.array([whole[a:b] for a, b in zip(begins, ends)], type=pa.binary()),
                        pa.array(size[lo:hi] < 0),
                    ],
                    ["bucket", "doc_id", "start", "units", "loose"],
                )

    return texts.mapInArrow(batches, "bucket long, doc_id long, start int, units binary, loose boolean")


def _windows_of(bucket, start, contexts, units: Units, named: bool):
    """Row number, window name, start, and bucket of every window in these contexts; if
    ``named`` a second name in place of the bucket."""
    lengths = np.array([len(c) for c in contexts], dtype=np.int64) // np.dtype(units.dtype).itemsize
    array = np.frombuffer(b"".join(contexts), dtype=units.dtype)
    begins = np.cumsum(lengths) - lengths
    counts = lengths - units.width + 1
    row = np.repeat(np.arange(len(lengths)), counts)
    step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = begins[row] + step
    names, ok = units.windows(array), units.inside(array)
    keep = ok[place]
    row, place, step = row[keep], place[keep], step[keep]
    more = units.windows(array, other=True)[place] if named else bucket[row]
    return row, names[place], more, start[row].astype(np.int64) + step


def _compare(contexts: DataFrame, units: Units, within: bool, crowd: int) -> DataFrame:
    """(doc_id, start, stop, name, more): runs of windows that occur earlier, without
    names; of crowded and hot buckets the other windows, with both their names. Windows
    are equal if their names agree and their buckets, or their second names."""

    def found(bucket, doc_id, start, texts, named: bool = False) -> Iterator[pa.RecordBatch]:
        row, names, more, place = _windows_of(bucket, start, texts, units, named)
        if not len(row):
            return
        order = np.lexsort((place, doc_id[row], names, more))
        row, names, more, place = row[order], names[order], more[order], place[order]
        group = np.r_[True, (names[1:] != names[:-1]) | (more[1:] != more[:-1])]
        lead = np.flatnonzero(group)[np.cumsum(group) - 1]
        docs = doc_id[row]
        again = docs != docs[lead]
        if within:
            again |= place != place[lead]
        if named:
            # Windows around several anchors come several times.
            new = group | np.r_[True, (docs[1:] != docs[:-1]) | (place[1:] != place[:-1])]
            rest = ~again & new
            yield spans(docs[rest], place[rest], place[rest] + units.width, names[rest], more[rest])
        row, place = row[again], place[again]
        if not len(row):
            return
        order = np.lexsort((place, row))
        row, place = row[order], place[order]
        begin = np.r_[True, (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)]
        head = np.flatnonzero(begin)
        tail = np.r_[head[1:], len(row)] - 1
        yield spans(doc_id[row[head]], place[head], place[tail] + units.width)

    def spans(doc_id, start, stop, *names) -> pa.RecordBatch:
        named = [pa.array(x.view(np.int64)) for x in names] or [pa.nulls(len(doc_id), pa.int64())] * 2
        columns = [pa.array(doc_id), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), *named]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "stop", "name", "more"])

    def every_window(bucket, doc_id, start, texts) -> Iterator[pa.RecordBatch]:
        yield from found(bucket, doc_id, start, texts, named=True)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, flood = None, None
        for part in parts:
            if not part.num_rows:
                continue
            rows = [*(x.to_numpy() for x in part.columns[:3]), np.array(part.column(3).to_pylist(), dtype=object)]
            loose = part.column(4).to_numpy(zero_copy_only=False)
            if loose.any():
                yield from every_window(*(x[loose] for x in rows))
                rows = [x[~loose] for x in rows]
                if not len(rows[0]):
                    continue
            if held is not None:
                rows = [np.concatenate(pair) for pair in zip(held, rows)]
                held = None
            if flood is not None:
                on = rows[0] == flood
                yield from every_window(*(x[on] for x in rows))
                rows = [x[~on] for x in rows]
                if not len(rows[0]):
                    continue
                flood = None
            open_ = rows[0] == rows[0][-1]
            yield from found(*(x[~open_] for x in rows))
            if open_.sum() > crowd:
                flood = rows[0][-1]
                yield from every_window(*(x[open_] for x in rows))
            else:
                held = [x[open_] for x in rows]
        if held is not None:
            yield from found(*held)

    return (
        contexts.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(batches, "doc_id long, start int, stop int, name long, more long")
    )


def _again(windows: DataFrame, within: bool) -> DataFrame:
    """The windows of crowded and hot buckets that occur earlier."""
    earliest = windows.groupBy("name", "more").agg(F.min(F.struct("doc_id", "start")).alias("least"))
    place = F.struct("doc_id", "start") if within else F.col("doc_id")
    lead = F.col("least") if within else F.col("least.doc_id")
    return windows.join(earliest, ["name", "more"]).where(place > lead).select("doc_id", "start", "stop").distinct()


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("key"), F.xxhash64(F.lit(7), text).alias("more"))


def repeated_spans(
    docs: DataFrame, units: Units, within: bool, crowd: int = CROWD, hot: float = HOT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spans of units covered by windows that occur earlier, and exact copies.

    Earlier means in a text with a smaller doc_id and, if ``within``, at a smaller
    place of the same text. Gives (doc_id, start, stop) spans that may overlap,
    (doc_id) of texts that equal one with a smaller id and are therefore not cut
    into units, and (doc_id, key): the key of the text that was judged for an id.
    Rows without id take no part. Of several texts under one id, the one with the
    least key is judged; of repeated rows one is, since a text is no earlier than itself."""
    known = docs.where("doc_id IS NOT NULL")
    keyed = store(_keyed(known).groupBy("doc_id", "key", "more").agg(F.count("*").alias("n")), "keys")
    chosen = keyed.groupBy("doc_id").agg(F.min(F.struct("key", "more", "n")).alias("k"))
    chosen = store(chosen.select("doc_id", "k.key", "k.more", "k.n"), "chosen")
    least = chosen.groupBy("key", "more").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    shared = store(least.where("n > 1").select("key", "more", "least"), "shared-texts")
    copied = lookup_join(chosen.drop("n"), shared, ["key", "more"], "inner").where("doc_id > least")
    copies = store(copied.select("doc_id"), "copies")
    judged = known.select("doc_id", "text")
    if keyed.count() > chosen.count():
        text_key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
        judged = lookup_join(judged.withColumn("key", text_key), chosen.select("doc_id", "key"), ["doc_id", "key"], "left_semi")
    judged = lookup_join(judged.select("doc_id", "text"), copies, ["doc_id"], "left_anti")
    if not chosen.where("n > 1").isEmpty():
        # Only the texts of repeated rows move.
        again = store(chosen.where("n > 1").select("doc_id"), "repeated-rows")
        single = lookup_join(judged, again, ["doc_id"], "left_anti")
        one = lookup_join(judged, again, ["doc_id"], "left_semi").dropDuplicates(["doc_id"])
        judged = single.unionByName(one)
    classes = store(_classes(_anchors(judged, units, within, hot), within), "classes")
    firsts = classes.where("bucket IS NOT NULL")
    compared = store(_compare(_contexts(judged, firsts, units), units, within, crowd), "compared")
    whole = classes.where("bucket IS NULL").select(
        "doc_id",
        F.greatest(F.col("at") + F.col("size") - units.width, F.lit(0)).alias("start"),
        (F.col("at") + units.width).alias("stop"),
    )
    runs = compared.where("name IS NULL").select("doc_id", "start", "stop")
    crowded = _again(compared.where("name IS NOT NULL"), within)
    return whole.unionByName(runs).unionByName(crowded), copies, chosen.select("doc_id", "key")


def with_spans(
    docs: DataFrame, found: tuple[DataFrame, DataFrame, DataFrame], kept: Callable, out: T.StructType
) -> DataFrame:
    """``docs`` with the columns that ``kept`` makes of a text, its spans and whether
    it is a copy: ``kept(text, starts, stops, copy)`` gives a tuple in the order of
    ``out``. Other columns of ``docs`` come along."""
    spans, copies, chosen = found
    marks = spans.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("_rs_spans")
    )
    marks = marks.join(copies.withColumn("_rs_copy", F.lit(True)), "doc_id", "full").join(chosen, "doc_id")
    marks = marks.select(F.col("doc_id").alias("_rs_id"), "_rs_spans", "_rs_copy", F.col("key").alias("_rs_key"))
    text_key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    joined = docs.join(marks, (F.col("doc_id") == F.col("_rs_id")) & (text_key == F.col("_rs_key")), "left")

    def batches(texts: pa.Array, found: pa.Array, copies: pa.Array):
        for text, places, copy in zip(texts, found, copies):
            spans = places.as_py() or []
            starts = np.array([s["start"] for s in spans], dtype=np.int64)
            stops = np.array([s["stop"] for s in spans], dtype=np.int64)
            yield kept(text.as_py() or b"", starts, stops, bool(copy.as_py()))

    names, pa_type = [field.name for field in out], _arrow_type(out)

    @F.arrow_udf(out)
    def cut(texts: pa.Array, found: pa.Array, copies: pa.Array) -> pa.Array:
        rows = batches(texts, found, copies)
        return pa.array([dict(zip(names, row)) for row in rows], type=pa_type)

    body = F.col("text").cast("string").cast("binary")
    cut_column = cut(body, F.col("_rs_spans"), F.col("_rs_copy")).alias("_rs_cut")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], cut_column)


def _arrow_type(schema: T.StructType) -> pa.DataType:
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
    return pa.struct([(field.name, kinds[field.dataType]) for field in schema])


def merged(starts: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint runs that cover the same units, cut to the text; input by start."""
    stops = np.minimum(stops, length)
    if not len(starts):
        return starts, stops
    reach = np.maximum.accumulate(stops)
    begin = np.r_[True, starts[1:] > reach[:-1]]
    head = np.flatnonzero(begin)
    return starts[head], reach[np.r_[head[1:], len(starts)] - 1]
