"""Near-duplicate documents by MinHash bands, odd sketches and exact verification.

1. Each text becomes its set of distinct word shingles.  Texts with equal sets are one *form*,
   so any number of exact copies costs one row from here on.
2. MinHash samples of a form are hashed into bands for candidates, and all of them are folded
   into an odd sketch: a bitmap that holds, per bit, the parity of the samples that fall on it.
   The population count of the XOR of two sketches estimates how many samples differ.
3. First round: every form of a bucket is held against its *hub* only, the member that shares
   most bands with other forms.
   Second round: in buckets that still hold several components, every pair of different
   components is held against each other.  Pairs inside one component are never listed, and no
   link that could join two components is skipped.  A form that is alone in having many of its
   shingles cannot reach the threshold with any other, for the similarity of a pair is at most
   ``m / (|a| + |b| - m)`` with m the most shingles it can share.  Shingles held by one open
   form are left out of m.  Those held by two or three (*rare* ones) are left out too when the
   forms of a bucket are held against each other; the pairs that share any of them are listed
   from their holders instead, with the exact number of rare shingles they share.  So a text
   that was edited heavily isn't held against all copies of its original, and no pair is lost:
   one without a common rare shingle shares frequent ones only.
4. The sketch is a condition of the join; pairs that pass are verified on the full sets.

The sketch cut lies five standard deviations beyond what two sets at the threshold show, so it
loses fewer than one link in a million; the bands lose about two (0.8 similarity, 25 x 4).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import SPACES, U64, mix, numbers, shingles, ship, slices, text_bytes, words
from stratalake.storage import written_copy

ship(__name__)
BANDS, ROWS = 25, 4
SAMPLES, SKETCH_LONGS = 400, 24  # the first BANDS * ROWS samples also make the bands
SKETCH = [f"_s{i}" for i in range(SKETCH_LONGS)]


def sketch_limit(samples: int, bits: int, similarity: float) -> int:
    """Largest XOR population count at which two sets may still be ``similarity`` alike."""
    differing = samples * (1 - similarity)
    expected = bits / 2 * (1 - math.exp(-4 * differing / bits))
    # Two sources of spread: which samples differ, and flips that meet on one bit.
    slope = 2 * math.exp(-4 * differing / bits)
    by_samples = slope**2 * samples * similarity * (1 - similarity)
    by_meeting = 4 * (2 * differing) ** 2 / (2 * bits)
    return min(bits, math.ceil(expected + 5 * math.sqrt(by_samples + by_meeting)))


def _signatures(size: int):
    """Arrow function: doc_id, text -> doc_id, set size, set fingerprint, bands, sketch."""
    samples = SAMPLES
    factor = (numbers(21, samples) >> U64(32)).astype(np.uint32) | np.uint32(1)
    shift = (numbers(22, samples) >> U64(32)).astype(np.uint32)
    bits = SKETCH_LONGS * 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, value = shingles(words(*text_bytes(batch.column("text")), SPACES), size)
            n = batch.num_rows
            count = np.bincount(row, minlength=n)
            full = np.flatnonzero(count)
            begin = np.concatenate([[0], np.cumsum(count[full])])[:-1]
            print_a, print_b = np.zeros(n, U64), np.zeros(n, U64)
            least = np.zeros((samples, len(full)), np.uint32)
            if len(full):
                print_a[full] = np.add.reduceat(mix(value ^ U64(0x5851F42D4C957F2D)), begin)
                print_b[full] = np.add.reduceat(mix(value ^ U64(0x14057B7EF767814F)), begin)
                small = (value >> U64(32)).astype(np.uint32)
                for i in range(samples):
                    least[i] = np.minimum.reduceat(small * factor[i] + shift[i], begin)
            keyed = mix(least.astype(U64) + (np.arange(samples, dtype=U64) << U64(32))[:, None])
            bands = np.zeros((n, BANDS), U64)
            for b in range(BANDS):
                part = keyed[b * ROWS : (b + 1) * ROWS]
                bands[full, b] = mix(sum(part[j] * U64(2 * j + 1) for j in range(ROWS)) + U64(b))
            hits = np.arange(len(full)) * bits + (keyed % U64(bits)).astype(np.int64)
            odd = (np.bincount(hits.ravel(), minlength=len(full) * bits) & 1).astype(np.uint8)
            sketch = np.zeros((n, SKETCH_LONGS), np.int64)
            sketch[full] = np.packbits(odd).view(np.int64).reshape(len(full), SKETCH_LONGS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(count.astype(np.int64)),
                    pa.array(print_a.view(np.int64)),
                    pa.array(print_b.view(np.int64)),
                    pa.FixedSizeListArray.from_arrays(
                        pa.array(bands.view(np.int64).ravel()), BANDS
                    ).cast(pa.list_(pa.int64())),
                    *(pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH_LONGS)),
                ],
                ["doc_id", "n_shingles", "_fa", "_fb", "_bands", *SKETCH],
            )

    return run


def _verified(size: int, percent: int):
    """Arrow function: pairs with both texts -> the pairs whose full sets are alike enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "_ta"), "_tb"):
            n = batch.num_rows
            # Neighbouring pairs often share their second text; its set is then made once.
            seconds = batch.column("_tb")
            fresh = np.ones(n, bool)
            other = pc.fill_null(pc.not_equal(seconds[1:], seconds[:-1]), True)
            fresh[1:] = other.to_numpy(zero_copy_only=False)
            which = np.cumsum(fresh) - 1
            ra, va = shingles(words(*text_bytes(batch.column("_ta")), SPACES), size)
            texts = seconds.take(pa.array(np.flatnonzero(fresh)))
            rb, vb = shingles(words(*text_bytes(texts), SPACES), size)
            ca, cb = np.bincount(ra, minlength=n), np.bincount(rb, minlength=int(fresh.sum()))
            ea, eb = np.concatenate([[0], np.cumsum(ca)]), np.concatenate([[0], np.cumsum(cb)])
            keep = np.zeros(n, bool)
            for i in range(n):
                j = which[i]
                a, b = va[ea[i] : ea[i + 1]], vb[eb[j] : eb[j + 1]]
                at = np.searchsorted(b, a)
                at[at == len(b)] = 0
                common = int((b[at] == a).sum()) if len(b) else 0
                keep[i] = 100 * common >= percent * (len(a) + len(b) - common) > 0
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _spread_out(size: int):
    """Arrow function: id, text -> id, shingle, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, value = shingles(words(*text_bytes(batch.column("text")), SPACES), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row)), pa.array(value.view(np.int64))],
                ["id", "shingle"],
            )

    return run


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for both ends of ``edges(a, b)``; the component is its smallest id.

    Every round takes the smallest label among neighbours and then jumps to that label's own
    label.  Labels only fall, so the rounds end when their sum no longer changes.
    """
    both = written_copy(
        edges.union(edges.select("b", "a")).toDF("a", "b").where("a <> b").distinct(), "links"
    )
    labels = both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.min("a"), F.min("b")).alias("component")
    )
    before = None
    for _ in range(max_rounds):
        labels = written_copy(labels, "labels")
        total = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if total == before or total is None:
            return labels
        before = total
        near = (
            both.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("_m"))
            .join(labels, "id")
            .select("id", F.least("_m", "component").alias("component"))
        )
        roots = labels.select(F.col("id").alias("component"), F.col("component").alias("_root"))
        labels = near.join(roots, "component", "left").select(
            "id", F.least("component", F.coalesce("_root", "component")).alias("component")
        )
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, for every row of ``docs(doc_id, text, ...)``.

    Null, empty and blank texts have no shingles and stay alone.  A text shorter than a shingle
    is one shingle.  Rows with equal doc_id are one document: they share a component if they
    are alike, and are then kept or dropped together.  A null doc_id takes no part: its
    component is null and it is kept.  Other columns are ignored, an empty table gives no rows.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    schema = (
        "doc_id long, n_shingles long, _fa long, _fb long, _bands array<long>, "
        + ", ".join(f"{c} long" for c in SKETCH)
    )
    signed = written_copy(source.mapInArrow(_signatures(words_per_shingle), schema), "signatures")
    forms = written_copy(
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("_fa", "_fb")
        .agg(
            F.min("doc_id").alias("id"),
            F.min("n_shingles").alias("n"),
            F.min("_bands").alias("_bands"),
            *(F.min(c).alias(c) for c in SKETCH),
        ),
        "forms",
    )
    # One document per form verifies it; a doc_id with several texts is told apart by its form.
    buckets = forms.select("id", F.explode("_bands").alias("bucket")).distinct()
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("_size")).where("_size > 1")
    crowded = written_copy(buckets.join(shared, "bucket"), "crowded")
    # The hub of a bucket is the member that shares most bands with others: among edited copies
    # that is the original or the least edited one, so most links are found against hubs.
    central = crowded.groupBy("id").agg(F.sum("_size").alias("_weight"))
    weighed = crowded.join(central, "id")
    hubs = weighed.groupBy("bucket").agg(
        F.max(F.struct("_weight", (-F.col("id")).alias("_minus"))).alias("_hub")
    )
    stars = crowded.join(hubs, "bucket").select(
        F.col("id").alias("a"), (-F.col("_hub._minus")).alias("b")
    )
    sketches = forms.select("id", *SKETCH)
    limit = sketch_limit(SAMPLES, SKETCH_LONGS * 64, percent / 100)
    differing = sum(
        (F.bit_count(F.col(f"l{c}").bitwiseXOR(F.col(f"r{c}"))) for c in SKETCH), F.lit(0)
    )

    def side(prefix: str, key: str) -> DataFrame:
        return sketches.toDF(key, *(f"{prefix}{c}" for c in SKETCH))

    def verify(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select("a").union(pairs.select("b")).toDF("doc_id").distinct()
        # A doc_id that repeats with other texts brings them all; any alike pair links the ids.
        # Dealt by id at every size, so that the plan does not change as the pairs grow.
        texts = written_copy(source.join(wanted.hint("merge"), "doc_id").distinct(), "texts")
        return written_copy(
            pairs.join(texts.toDF("a", "_ta"), "a")
            .join(texts.toDF("b", "_tb"), "b")
            .mapInArrow(_verified(words_per_shingle, percent), "a long, b long"),
            "verified",
        )

    first = (
        stars.where("a <> b")
        .distinct()
        .join(side("l", "a"), "a")
        .join(side("r", "b"), "b")
        .where(differing <= limit)
        .select("a", "b")
    )
    links = verify(written_copy(first, "pairs"))
    labels = components(links)
    member = written_copy(
        crowded.select("id", "bucket")
        .join(labels, "id", "left")
        .select("id", "bucket", F.coalesce("component", "id").alias("component")),
        "members",
    )
    mixed = (
        member.groupBy("bucket", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(F.max(F.struct("n", "component")).alias("_most"), F.count("*").alias("_kinds"))
        .where("_kinds > 1")
        .select("bucket", F.col("_most.component").alias("_main"))
    )
    open_members = written_copy(member.join(mixed, "bucket"), "open")
    open_ids = written_copy(open_members.select("id", "component").distinct(), "open-ids")
    holders = written_copy(
        source.join(open_ids.select(F.col("id").alias("doc_id")), "doc_id")
        .select(F.col("doc_id").alias("id"), "text")
        .mapInArrow(_spread_out(words_per_shingle), "id long, shingle long")
        .groupBy("shingle")
        .agg(
            F.count("*").alias("_n"),
            F.min("id").alias("_low"),
            F.max("id").alias("_high"),
            F.bit_xor("id").alias("_xor"),
        )
        .where("_n <= 3 or _low = _high"),
        "holders",
    )
    alone = holders.where("_low = _high").groupBy(F.col("_low").alias("id")).agg(
        F.count("*").alias("alone")
    )
    # The third of three holders is what the other two leave of the XOR; a repeated row may
    # stand for one of them.
    third = F.when(
        F.col("_n") == 3, F.col("_xor").bitwiseXOR(F.col("_low")).bitwiseXOR(F.col("_high"))
    ).otherwise(F.col("_low"))
    rare = holders.where("_low <> _high").select("_low", third.alias("_mid"), "_high")
    scarce = (
        rare.select(F.explode(F.array_distinct(F.array("_low", "_mid", "_high"))).alias("id"))
        .groupBy("id")
        .agg(F.count("*").alias("scarce"))
    )
    # What was counted for a doc_id holds for its form only if the doc_id has no other text.
    plain = (
        signed.join(open_ids.select(F.col("id").alias("doc_id")), "doc_id")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(
            ((F.min("_fa") == F.max("_fa")) & (F.min("_fb") == F.max("_fb"))).alias("_plain")
        )
        .where("_plain")
    )
    seldom = F.when(F.col("_plain"), F.coalesce("alone", F.lit(0))).otherwise(0)
    rarely = F.when(F.col("_plain"), F.coalesce("scarce", F.lit(0))).otherwise(0)
    sized = written_copy(  # an id with several texts has a row for each, with its own sketch
        forms.join(open_ids, "id")
        .join(alone, "id", "left")
        .join(scarce, "id", "left")
        .join(plain, "id", "left")
        .select(
            "id",
            "component",
            "n",
            (F.col("n") - seldom).alias("shared"),
            (F.col("n") - seldom - rarely).alias("frequent"),
            *SKETCH,
        ),
        "sized",
    )
    # Alone, no partner can lift a form above shared / n; such forms need no comparison.
    hopeful = sized.where(F.col("frequent") * 100 >= F.col("n") * percent).drop("component")
    # A pair of different components meets in every open bucket it shares; the first one lists it.
    where_open = open_members.groupBy("id").agg(F.collect_set("bucket").alias("_open"))
    candidates = written_copy(
        open_members.join(hopeful, "id").join(where_open, "id"), "hopeful"
    )
    right = candidates.select(
        "bucket",
        F.col("id").alias("b"),
        F.col("component").alias("_cb"),
        (F.col("component") == F.col("_main")).alias("_in_main"),
        F.col("n").alias("_nb"),
        F.col("frequent").alias("_hb"),
        F.col("_open").alias("_ob"),
        *(F.col(c).alias(f"r{c}") for c in SKETCH),
    )
    left = candidates.where("component <> _main").select(
        "bucket",
        F.col("id").alias("a"),
        F.col("component").alias("_ca"),
        F.col("n").alias("_na"),
        F.col("frequent").alias("_ha"),
        F.col("_open").alias("_oa"),
        *(F.col(c).alias(f"l{c}") for c in SKETCH),
    )
    def reaches(most) -> Column:
        return most * 100 >= (F.col("_na") + F.col("_nb") - most) * percent

    banded = (
        left.join(
            right,
            (left["bucket"] == right["bucket"])
            & (F.col("_ca") != F.col("_cb"))
            & (F.col("_in_main") | (F.col("a") < F.col("b")))
            & reaches(F.least("_ha", "_hb"))
            & (differing <= limit)
            & (F.array_min(F.array_intersect("_oa", "_ob")) == left["bucket"]),
        )
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    low, mid, high = F.col("_low"), F.col("_mid"), F.col("_high")
    by_rare = (
        rare.select(
            F.explode(
                F.array_distinct(
                    F.array(*(F.struct(x.alias("a"), y.alias("b"))
                              for x, y in ((low, mid), (mid, high), (low, high))))
                )
            ).alias("p")
        )
        .select("p.*")
        .where("a <> b")
        .groupBy("a", "b")
        .agg(F.count("*").alias("_r"))
    )

    def half(end: str, prefix: str) -> DataFrame:
        return sized.where(F.col("shared") * 100 >= F.col("n") * percent).select(
            F.col("id").alias(end),
            F.col("component").alias(f"_c{end}"),
            F.col("n").alias(f"_n{end}"),
            F.col("shared").alias(f"_s{end}"),
            F.col("frequent").alias(f"_f{end}"),
            *(F.col(c).alias(f"{prefix}{c}") for c in SKETCH),
        )

    several = (
        by_rare.join(half("a", "l"), "a")
        .join(half("b", "r"), "b")
        .where("_ca <> _cb")
        .where(reaches(F.least("_sa", "_sb", F.col("_r") + F.least("_fa", "_fb"))))
        .where(differing <= limit)
        .select("a", "b")
    )
    more = verify(written_copy(banded.union(several).distinct(), "pairs"))
    labels = components(links.union(more))
    by_form = forms.join(labels, "id", "left").select(
        "_fa", "_fb", F.coalesce("component", "id").alias("_component")
    )
    held = F.col("n_shingles") > 0
    spread = F.when(held, F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) + 1)
    # Rows without words never match, so they are spread instead of meeting on one key.
    return (
        signed.select("doc_id", "n_shingles", "_fa", "_fb", spread.alias("_x"))
        .join(by_form.withColumn("_x", F.lit(0).cast("long")), ["_fa", "_fb", "_x"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias(
                "component_id"
            ),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM d
  UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON e.a = reach.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id,
  d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""
