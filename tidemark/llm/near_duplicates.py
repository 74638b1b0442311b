"""Near-duplicate documents: fast similarity sketches, banding, and exact verification on the full shingle sets.

The sketch of a set has `COORDINATES` places. In round r every shingle is hashed to one place with the value
(r, hash), and a place keeps its least value; a place that round r fills can't change later. Rounds 0 to
COORDINATES - 1 choose the place by hash; round COORDINATES + i sends every shingle to place i, so that no place
stays empty. Two sets agree in a place with their Jaccard similarity as probability, and the number of agreeing
places is concentrated as if the places were drawn independently.

Sets above the threshold meet in at least one of 25 bands of 5 places but for a chance of 4e-7 at a similarity of
0.85, and less above it. For thresholds from 0.80 to under 0.85 there are 32 bands of 4 places, which miss a pair at 0.80
with a chance of 5e-8. Documents with equal sets are one class and are compared once. In a band each class is
compared with the most central class there, the one whose bands hold the most classes (of a group of edited copies,
that is a text close to the original). When the links found so far have been joined into components, only classes of
different components that share a band are still compared, so that groups of copies never make all their pairs. Of
those, a pair is left out if its intersection can't be large enough: it holds no more than what each class shares with any other
component, and, for two classes A and B of the same centre C, no more than min(|A & C|, |B & C|) plus the shingles outside C
that the one with fewer of them shares with other components. In a group of copies with edits of their own, these
bounds, which are exact, drop nearly all pairs that no link joins.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.helpers import arrow_map, keep
from tidemark.llm.words import mix, shingle_hashes, slices, text_buffers, text_shingles, word_hashes

COORDINATES = 128
#: From a threshold in percent on: bands, the places of each, and the number of agreeing places above which a pair is verified.
#: At a similarity of 0.85, 84 or fewer of 128 agree with a chance of 1e-8, at 0.80 74 or fewer (binomial tails).
LAYOUTS = {85: (25, 5, 84), 80: (32, 4, 74)}
_U = np.uint64
_UNSET = np.iinfo(np.uint64).max


def sketches(elements: np.ndarray, bounds: np.ndarray, places: int = COORDINATES) -> np.ndarray:
    """A row of 16-bit places for each set; `elements` are hashes, set i between bounds[i] and bounds[i + 1]."""
    counts = np.diff(bounds)
    sketch = np.full((len(counts), places), _UNSET, dtype=_U)
    flat = sketch.reshape(-1)
    owner = np.repeat(np.arange(len(counts)), counts)
    for r in range(2 * places):
        if not len(elements):
            break
        h = mix(elements + _U((r * 0xD1B54A32D192ED03 + 0x8CB92BA72F3D8DD7) % (1 << 64)))
        place = ((h >> _U(32)) * _U(places) >> _U(32)).astype(np.int64) if r < places else r - places
        np.minimum.at(flat, owner * places + place, (h & _U(0xFFFFFFFF)) | _U(r << 32))
        open_sets = (sketch == _UNSET).any(axis=1)
        left = open_sets[owner]
        elements, owner = elements[left], owner[left]
    return (mix(sketch) >> _U(48)).astype(np.uint16)


def sketch_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, digest, sketch) of every row; digest tells sets apart, sketch is null for empty sets."""

    def work(batch: pa.RecordBatch):
        for part in slices(batch, "text"):
            words, bounds = word_hashes(*text_buffers(part.column("text")))
            shingles, bounds = shingle_hashes(words, bounds)
            sets = [np.unique(shingles[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            drawn = sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(sizes),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([r.tobytes() if n else None for r, n in zip(drawn, sizes, strict=True)], pa.binary()),
                ],
                ["id", "n_shingles", "digest", "sketch"],
            )

    columns = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return arrow_map(columns, work, "id long, n_shingles long, digest binary, sketch binary")


def _layout(percent: int) -> tuple[int, int, int]:
    """The layout of the largest threshold that is not above `percent`."""
    return LAYOUTS[max(p for p in LAYOUTS if p <= percent)]


def _band_rows(classes: DataFrame, percent: int) -> DataFrame:
    """(band, id) for each class and band; the key holds the number of the band."""
    bands, places, _ = _layout(percent)
    keys = [
        F.xxhash64(F.lit(k), F.substring("sketch", 1 + 2 * places * k, 2 * places)) for k in range(bands)
    ]
    return classes.select("id", F.explode(F.array(*keys)).alias("band"))


def _alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches agree in as many places as the layout asks for."""
    agree = _layout(percent)[2]
    side = lambda c: classes.select(F.col("id").alias(c), F.col("sketch").alias(f"sketch_{c}"))

    def work(batch: pa.RecordBatch):
        one, two = (
            np.frombuffer(b"".join(batch.column(f"sketch_{c}").to_pylist()), dtype=np.uint16).reshape(-1, COORDINATES)
            for c in "ab"
        )
        keep = pa.array((one == two).sum(axis=1) > agree)
        yield batch.select(["a", "b"]).filter(keep)

    return arrow_map(pairs.join(side("a"), "a").join(side("b"), "b"), work, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union, compared as words."""
    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}"))

    def work(batch: pa.RecordBatch):
        keep, last, held = [], None, set()
        for a, b in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
            if (b := b.as_py()) != last:
                last, held = b, text_shingles(b)
            other = text_shingles(a.as_py())
            both = len(held & other)
            keep.append(100 * both >= percent * (len(held) + len(other) - both) > 0)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return arrow_map(pairs.join(side("b"), "b").join(side("a"), "a"), work, "a long, b long")


def _shared_elsewhere(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, component, center, n, common, inside, outside) of each id: its shingles, those that another component has too,
    those that its centre has, and those that another component has and its centre has not.

    Of an id with several texts, n is that of the smallest and the others are those of all, which keeps bounds bounds.
    """
    pool = placed.groupBy("id", "component").agg(F.max_by("hub", F.struct("size", F.negative("hub"))).alias("center"))
    centers = pool.select(F.col("center").alias("id"), F.lit(True).alias("is_center")).distinct()
    pool = pool.join(centers, "id", "left")

    def work(batch: pa.RecordBatch):
        for part in slices(batch, "text"):
            shingles, bounds = shingle_hashes(*word_hashes(*text_buffers(part.column("text"))))
            columns = [part.column(c).to_pylist() for c in ("id", "component", "center", "is_center")]
            for i, (key, component, center, is_center) in enumerate(zip(*columns, strict=True)):
                own = np.unique(shingles[bounds[i] : bounds[i + 1]]).view(np.int64)
                # A centre that has another centre itself also lies among those that have it as theirs.
                for of in (center, key) if is_center and center != key else (center,):
                    values = [np.full(len(own), v, dtype=np.int64) for v in (key, component, of, len(own), center)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own), *map(pa.array, values)], ["shingle", "id", "component", "center", "size", "own_center"]
                    )

    # One exchange, by shingle: who else has it, and whether the centre has.
    rows = arrow_map(
        texts.join(pool, "id"), work, "shingle long, id long, component long, center long, size long, own_center long"
    )
    holders, beside = Window.partitionBy("shingle"), Window.partitionBy("shingle", "center")
    told = rows.select(
        "id", "component", "center", "size", "own_center",
        (F.min("component").over(holders) < F.max("component").over(holders)).cast("long").alias("common"),
        F.max((F.col("id") == F.col("center")).cast("long")).over(beside).alias("inside"),
    ).filter("center = own_center")
    return told.groupBy("id", "component", "center").agg(
        F.min("size").alias("n"), F.sum("common").alias("common"), F.sum("inside").alias("inside"),
        F.sum(F.col("common") * (1 - F.col("inside"))).alias("outside"),
    )


def _across(placed: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of different components that meet in a band and may reach the threshold.

    A pair comes from the first of the bands that it meets in.
    """
    bands = placed.groupBy("id").agg(F.array_sort(F.collect_list("band")).alias("bands"))
    rows = placed.select("band", "id").join(bands, "id").join(shared, "id").filter(
        F.col("common") * 100 >= F.col("n") * percent
    )
    side = lambda c: rows.select("band", *(F.col(x).alias(f"{x}_{c}") for x in ("id", "component", "center", "bands", "n", "common", "inside", "outside")))
    together = F.least("inside_a", "inside_b") + F.least("outside_a", "outside_b")
    most = F.least("common_a", "common_b", F.when(F.col("center_a") == F.col("center_b"), together))
    first = F.element_at(F.array_intersect("bands_a", "bands_b"), 1)
    pairs = side("a").alias("x").join(
        side("b").alias("y"),
        (F.col("x.band") == F.col("y.band"))
        & (F.col("id_a") > F.col("id_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (most * 100 >= (F.col("n_a") + F.col("n_b") - most) * percent)
        & (first == F.col("x.band")),
    )
    return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 85
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of `docs`.

    Documents are linked if 100 * intersection >= percent * union of their distinct five-word shingles; percent is 80
    or more. component_id is
    the smallest id that links lead to. Rows without words, with a null text or a null id are linked with nothing;
    a null id has a null component and is kept. Rows that repeat an id are one vertex. Other columns are not read.
    """
    if percent < 80:
        raise ValueError("the bands find links of 80 percent or more")
    drawn = keep(sketch_documents(docs, id_column, text_column))
    named = drawn.filter("id is not null")
    classes = keep(
        named.filter("n_shingles > 0").groupBy("digest").agg(F.min(F.struct("id", "sketch")).alias("first"))
        .select("digest", "first.id", "first.sketch")
    )
    firsts = classes.select("digest", F.col("id").alias("first"))
    members = keep(
        named.select("id", "digest").join(firsts, "digest", "left").select("id", F.coalesce("first", "id").alias("first"))
        .distinct()
    )
    repeated = members.groupBy("id").agg(F.min("first").alias("least"), F.max("first").alias("most"))
    links = members.join(repeated.filter("least < most"), "id").filter("first > least").select(
        F.col("first").alias("a"), F.col("least").alias("b")
    )
    bands = _band_rows(classes, percent)
    sizes = bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    shared = keep(bands.join(sizes, "band"))
    busy = keep(shared.select("id").distinct())
    classes = keep(classes.select("id", "sketch").join(busy, "id", "left_semi"))
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    texts = keep(texts.join(busy, "id", "left_semi"))
    central = shared.groupBy("id").agg(F.sum("n").alias("rank"))
    hubs = keep(shared.join(central, "id").groupBy("band").agg(F.max_by("id", F.struct("rank", -F.col("id"))).alias("hub")))
    spokes = shared.join(hubs, "band").filter("id <> hub").select(
        F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")
    )
    first_pairs = keep(_alike(spokes.distinct(), classes, percent))
    links = keep(links.union(_verified(first_pairs, texts, percent)))
    found = connected_components(links)
    placed = shared.select("band", "id", F.col("n").alias("size")).join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    placed = keep(placed.join(mixed.filter("least < most").select("band"), "band").join(hubs, "band"))
    across = _across(placed, _shared_elsewhere(placed, texts), percent)
    more = keep(_alike(across, classes, percent).join(first_pairs, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        found = connected_components(links.union(_verified(more, texts, percent)))
    labels = members.join(found.withColumnRenamed("id", "first"), "first", "left").groupBy("id").agg(
        F.min(F.coalesce("component", "first")).alias("component_id")
    )
    return (
        drawn.select("id", "n_shingles").join(labels, "id", "left")
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    )
