"""Operator 13, hard-negative mining by a secondary-sort shuffle.

Scores are integer inner products of quantised vectors.  Every anchor is scored against all
rows, in blocks: anchors are dealt to blocks by a hash of their id, rows to shares, and a task
takes one block through one share, a packed chunk of rows at a time.  Two passes:

1. the best ``n_positives`` rows of the anchor's label in each share, then of all shares;
2. the best ``n_negatives`` rows of other labels in each share inside the window that each
   positive opens (``low * p <= 100 * score <= high * p``), since no other row of that share can be
   among the first of that window.

What is left are pairs of a few rows for each anchor and share.  Their scores are packed into
(anchor, descending score, positives before negatives, id) keys and go through one shuffle by
anchor with a sort inside partitions (``repartition`` + ``sortWithinPartitions``: the DataFrame
form of ``repartitionAndSortWithinPartitions``, on binary rows instead of pickled ones).  A streaming
iterator then opens a window at each positive and emits negatives until the window has
``n_negatives`` of them; it holds the open windows of one anchor, never its rows.

No anchor, label or share is hot: an anchor's pairs are bounded by shares * (5 + 15), labels only
mask scores, and rows are dealt by position, not by label.

Edge cases: rows with a null id, label or vector or a null or non-finite component take no part; of
rows that repeat a ``vec_id`` the one with the smallest label, then vector, counts; ties in score
go by smaller id; vectors of different lengths are not compared, empty ones all score 0; positives
of negative score open an empty window, those of score 0 one for score 0; scaled components are
held within the range in which no score leaves 64 bits; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import own_session, spill_table

CHUNK = 2048          # rows packed into one record
RECORDS = 8           # records to an Arrow batch
ANCHORS = 4096        # anchors in a block, about
CHUNKS_A_SHARE = 256  # rows of a share: 2048 * 256

PAIRS = "anchor_id long, score long, id long, positive boolean"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(vectors: DataFrame, scale: int = 256, relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """``vec_id, label, q``: floor(scale * x) of each component; label + 1 mod ``labels`` where the id divides."""
    whole = F.filter("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    fit = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size(whole) == 0))
    # |score| < 2^56, so 19 * score stays in 64 bits
    bound = F.floor(F.sqrt(F.lit(float(1 << 56)) / F.greatest(F.size("embedding"), F.lit(1))))
    q = F.transform("embedding", lambda x: F.greatest(F.least(F.floor(F.least(F.greatest(x.cast("double"), F.lit(-1e12)), F.lit(1e12)) * scale), bound), -bound))
    label = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    one = fit.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").alias("first"), label.cast("long").alias("label"), q.alias("q")).alias("v"))
    return one.groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", "v.label", "v.q")


def _packed(batches):
    """Rows -> records of up to ``CHUNK`` rows of one length, in ascending id, with the matrix as bytes."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        ids = np.asarray(b.column(0), "int64")
        labels = np.asarray(b.column(1), "int64")
        lists = b.column(2)
        sizes = np.diff(np.asarray(lists.offsets))
        flat, first = np.asarray(lists.values, "int64"), np.asarray(lists.offsets)[:-1]
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            at = at[np.argsort(ids[at], kind="stable")]
            for i in range(0, len(at), CHUNK):
                rows = at[i:i + CHUNK]
                m = flat[first[rows][:, None] + np.arange(dim)] if dim else np.zeros((len(rows), 0), "int64")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(dim)], pa.int32()), pa.array([ids[rows].tobytes()], pa.binary()),
                     pa.array([labels[rows].tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())],
                    names=["dim", "ids", "labels", "m"])


def products(a, b):
    """Exact integer products of the rows of two int64 matrices; in doubles where those are exact."""
    import numpy as np

    peak = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if peak < 2.0 ** 53:
        return (a.astype("float64") @ b.astype("float64").T).astype("int64")
    return a @ b.T


NONE = -(1 << 62)


def best(scores, fits, ids, keep):
    """Per column the first ``keep`` rows that fit, by descending score, then row; rows are in order of id.

    Returns (scores, ids), each columns x keep, filled up with ``NONE``.
    """
    import numpy as np

    rows, cols = scores.shape
    masked = np.where(fits, scores, NONE).T  # a column is now a row in memory
    k = min(keep, rows)
    out_s = np.full((cols, keep), NONE, "int64")
    out_i = np.full((cols, keep), -1, "int64")
    if k < rows:
        # the k-th best score, then the earliest rows among its ties
        floor = -np.partition(-masked, k - 1, axis=1)[:, k - 1:k]
        sure = masked > floor
        ties = (masked == floor) & (masked > NONE)
        ties &= np.cumsum(ties, axis=1) <= k - sure.sum(axis=1, keepdims=True)
        hit = sure | ties
    else:
        hit = masked > NONE
    c, r = np.nonzero(hit)
    s = masked[c, r]
    order = np.lexsort((r, -s, c))
    c, r, s = c[order], r[order], s[order]
    slot = np.arange(len(c)) - np.searchsorted(c, c)
    out_s[c, slot], out_i[c, slot] = s, ids[r]
    return out_s, out_i


def merged(s, i, s2, i2):
    """Two tables of best rows -> the best of both, by descending score, then id."""
    import numpy as np

    keep = s.shape[-1]
    s, i = np.concatenate([s, s2], -1), np.concatenate([i, i2], -1)
    order = np.lexsort((i, -s), axis=-1)[..., :keep]
    return np.take_along_axis(s, order, -1), np.take_along_axis(i, order, -1)


def _scored(keep: int, same: bool, low: int, high: int, step: int = 256):
    """Records of (block, share), anchors before rows -> the best rows of the share for each anchor or window.

    ``same``: rows of the anchor's label.  Otherwise rows of other labels inside the windows of the
    anchor's positives, whose scores come with the anchors.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        group, ids, labels, m, tops, state = None, [], [], [], [], None

        def ready():
            """Anchors are complete: join their records."""
            nonlocal ids, labels, m, tops, state
            ids, labels, m = np.concatenate(ids), np.concatenate(labels), np.concatenate(m)
            tops = np.concatenate(tops) if tops else None
            windows = 1 if same else tops.shape[1]
            state = (np.full((len(ids), windows, keep), NONE, "int64"), np.full((len(ids), windows, keep), -1, "int64"))

        def take(row_ids, row_labels, rows):
            for a in range(0, len(ids), step):
                z = slice(a, a + step)
                scores = products(rows, m[z])
                alike = row_labels[:, None] == labels[z][None, :]
                if same:
                    fits = [alike & (row_ids[:, None] != ids[z][None, :])]
                else:
                    fits = []
                    for w in range(tops.shape[1]):
                        p = tops[z, w]
                        lo, hi = -(-low * p // 100), high * p // 100
                        fits.append(~alike & (scores >= lo) & (scores <= hi) & (p > NONE))
                for w, f in enumerate(fits):
                    if f.any():
                        got = best(scores, f, row_ids, keep)
                        state[0][z, w], state[1][z, w] = merged(state[0][z, w], state[1][z, w], *got)

        def found():
            if state is None:
                return
            s, i = state
            anchor = np.broadcast_to(ids[:, None, None], s.shape)
            ok = s > NONE
            rows = np.unique(np.stack([anchor[ok], s[ok], i[ok]], 1), axis=0)  # a row may stand in several windows
            for a in range(0, len(rows), 100_000):
                r = rows[a:a + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(r[:, 0]), pa.array(r[:, 1]), pa.array(r[:, 2]), pa.array(np.full(len(r), same))],
                                                 names=["anchor_id", "score", "id", "positive"])

        for b in batches:
            for dim, block, share, is_row, r_ids, r_labels, r_m, r_tops in zip(*(b.column(x) for x in ("dim", "block", "share", "is_row", "ids", "labels", "m", "tops"))):
                key = (dim.as_py(), block.as_py(), share.as_py())
                if key != group:
                    yield from found()
                    group, ids, labels, m, tops, state = key, [], [], [], [], None
                one = np.frombuffer(r_ids.as_buffer(), "int64"), np.frombuffer(r_labels.as_buffer(), "int64"), np.frombuffer(r_m.as_buffer(), "int64").reshape(-1, key[0]) if key[0] else None
                if one[2] is None:
                    one = one[0], one[1], np.zeros((len(one[0]), 0), "int64")
                if not is_row.as_py():
                    ids.append(one[0])
                    labels.append(one[1])
                    m.append(one[2])
                    if r_tops.is_valid:
                        tops.append(np.frombuffer(r_tops.as_buffer(), "int64").reshape(len(one[0]), -1))
                elif len(ids):
                    if state is None:
                        ready()
                    take(*one)
        yield from found()

    return run


def _packed_anchors(windows: int):
    """Anchors of one block after another -> records; with the scores of their positives if there are any."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            block = np.asarray(b.column(3), "int64")
            lists = b.column(2)
            off = np.asarray(lists.offsets)
            sizes, flat = np.diff(off), np.asarray(lists.values, "int64")
            ids, labels = np.asarray(b.column(0), "int64"), np.asarray(b.column(1), "int64")
            tops = None
            if windows:
                tops = np.array([(list(x) + [NONE] * windows)[:windows] for x in b.column(4).to_pylist()], "int64").reshape(-1, windows)
            for dim, one in sorted(set(zip(sizes.tolist(), block.tolist()))):
                at = np.flatnonzero((sizes == dim) & (block == one))
                for i in range(0, len(at), CHUNK):
                    r = at[i:i + CHUNK]
                    m = flat[off[:-1][r][:, None] + np.arange(dim)] if dim else np.zeros((len(r), 0), "int64")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.array([one], pa.int64()), pa.array([ids[r].tobytes()], pa.binary()),
                         pa.array([labels[r].tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary()),
                         pa.array([tops[r].tobytes() if windows else None], pa.binary())],
                        names=["dim", "block", "ids", "labels", "m", "tops"])

    return run


def _search(anchors: DataFrame, chunks: DataFrame, blocks: int, shares: int, kernel, windows: int) -> DataFrame:
    """The kernel over every (block of anchors, share of rows): both sides are copied to the tasks that need them."""
    packed = spill_table(anchors.repartition("block").sortWithinPartitions("block").mapInArrow(
        _packed_anchors(windows), "dim int, block long, ids binary, labels binary, m binary, tops binary"),
        "negatives-anchors", chunks.sparkSession)
    a = packed.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)).cast("array<long>"))).withColumn("is_row", F.lit(False))
    r = (chunks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
         .withColumn("is_row", F.lit(True)).withColumn("tops", F.lit(None).cast("binary")))
    both = a.unionByName(r).repartition("dim", "block", "share").sortWithinPartitions("dim", "block", "share", "is_row")
    return both.mapInArrow(kernel, PAIRS)


def _first_positives(keep: int):
    """Pairs in order of (anchor, descending score, id) -> the first ``keep`` of each anchor."""

    def run(batches):
        import numpy as np

        held, n = None, 0
        for b in batches:
            a = np.asarray(b.column(0), "int64")
            if not len(a):
                continue
            at = np.arange(len(a)) - np.searchsorted(a, a) + np.where(a == held, n, 0)
            last = int((a == a[-1]).sum()) + (n if a[-1] == held else 0)
            held, n = a[-1], last
            yield b.take(np.flatnonzero(at < keep))

    return run


def _windows(n_positives: int, n_negatives: int, low: int, high: int):
    """Pairs in order of (anchor, descending score, positives first, id) -> negatives of each window.

    A window opens at its positive and closes with its last negative or below its lowest score.
    """

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()),
                            ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())])
        anchor, seen, opened = None, 0, []
        for b in batches:
            out = []
            for a, score, i, positive in zip(*(x.to_pylist() for x in b.columns)):
                if a != anchor:
                    anchor, seen, opened = a, 0, []
                if positive:
                    if seen < n_positives:
                        seen += 1
                        opened.append([i, score, 0])
                    continue
                opened = [w for w in opened if w[2] < n_negatives and low * w[1] <= 100 * score]
                for w in opened:
                    if 100 * score <= high * w[1]:
                        w[2] += 1
                        out.append((a, w[0], w[2], i, w[1], score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def mine(vectors: DataFrame, anchor_every: int = 50, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
         anchors_a_block: int = ANCHORS, chunks_a_share: int = CHUNKS_A_SHARE) -> DataFrame:
    """``MINED`` rows; ``vectors``: vec_id, label, q (lists of whole numbers), one row an id.

    Anchors are the rows whose id ``anchor_every`` divides.  ``rank`` counts a positive's negatives from 1.
    """
    caller = vectors.sparkSession
    spark = own_session(caller, RECORDS)  # for the records; rows and pairs go in batches of the caller's size
    rows = spill_table(vectors.select("vec_id", "label", "q"), "negatives-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % anchor_every == 0, 1)).alias("a")).first()
    blocks = max(1, -(-size["a"] // anchors_a_block))
    # at least two tasks a core, no share under one chunk
    chunks_n = max(1, -(-size["n"] // CHUNK))
    shares = min(chunks_n, max(-(-chunks_n // chunks_a_share), -(-2 * spark.sparkContext.defaultParallelism // blocks)))
    chunks = rows.mapInArrow(_packed, "dim int, ids binary, labels binary, m binary")
    chunks = spill_table(chunks.withColumn("share", F.pmod(F.xxhash64("ids"), F.lit(shares)).cast("long")), "negatives-chunks", spark)
    anchors = rows.where(F.col("vec_id") % anchor_every == 0).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("long"))
    order = ("anchor_id", F.desc("score"), F.desc("positive"), "id")
    near = spill_table(_search(anchors.select("vec_id", "label", "q", "block"), chunks, blocks, shares, _scored(n_positives, True, low, high), 0),
                       "negatives-near", caller)
    positives = spill_table(near.repartition("anchor_id").sortWithinPartitions(*order).mapInArrow(_first_positives(n_positives), PAIRS), "negatives-positives")
    tops = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list("score"), asc=False).alias("tops"))
    placed = anchors.join(tops, "vec_id").select("vec_id", "label", "q", "block", "tops")
    far = spill_table(_search(placed, chunks, blocks, shares, _scored(n_negatives, False, low, high), n_positives), "negatives-far", caller)
    pairs = positives.unionByName(far)
    return pairs.repartition("anchor_id").sortWithinPartitions(*order).mapInArrow(_windows(n_positives, n_negatives, low, high), MINED)
