"""SimHash near-duplicates, found through Golay-code fuzzy keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweir.llm.batches import bounded
from docweir.llm.components import connected_components
from docweir.llm.golay import fuzzy_keys
from docweir.storage import materialize

SEED = 42
MAX_DISTANCE = 2
#: Offset and length of the three segments of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: A fuzzy key with more distinct fingerprints than this is linked through midpoints instead of pairs.
PAIRWISE_LIMIT = 32


def shingles(text: str | None, n_words: int) -> list[bytes]:
    """Word shingles of a lower-cased text, repeats included; a shorter text is one shingle, no words give none."""
    words = (text or "").encode().lower().split()
    joined = b" ".join(words)
    if len(words) <= n_words:
        return [joined] if words else []
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.r_[0, ends[:-n_words]].tolist()
    return [joined[a:b] for a, b in zip(starts, (ends[n_words - 1 :] - 1).tolist(), strict=True)]


def digests(text: str | None, n_words: int) -> np.ndarray:
    """The hashes of a text's shingles as rows of eight bytes, the high one first."""
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(s, SEED) for s in shingles(text, n_words)]), dtype=np.uint8).reshape(-1, 8)


def bit_sums(rows: np.ndarray) -> np.ndarray:
    """How many rows of bytes have each bit set; up to 255 rows are added as bytes, eight bytes at a time."""
    total = np.zeros(rows.shape[1] * 8, dtype=np.int64)
    for k in range(0, len(rows), 255):
        total += np.unpackbits(rows[k : k + 255], axis=1).view(np.uint64).sum(axis=0).view(np.uint8)
    return total


def majority(rows: np.ndarray) -> int:
    """64 bits, each set if it is set in over half the rows; as a signed long."""
    return int.from_bytes(np.packbits(2 * bit_sums(rows) > len(rows)).tobytes(), "big", signed=True)


def fingerprint(text: str | None, n_words: int) -> int:
    """64 bits, each set if it is set in over half the hashes of the shingles; as a signed long."""
    return majority(digests(text, n_words))


def fingerprints(docs: DataFrame, n_words: int = 3) -> DataFrame:
    """(row_id, doc_id, fp) of every whole text."""

    def run(batches):
        for batch in bounded(batches):
            fps = [fingerprint(t, n_words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), pa.array(fps, pa.int64())], names=["row_id", "doc_id", "fp"]
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text").mapInArrow(
        run, f"row_id bigint, doc_id {doc_id}, fp bigint"
    )


def segment_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, index of the fingerprint): keys that fingerprints within two bits are sure to share.

    Two errors cannot hit all three segments, so some segment is equal; each key joins
    one exact segment with a codeword index near the next segment, in which at most two
    bits differ.
    """
    unsigned = fps.astype(np.int64).view(np.uint64)
    parts = [(unsigned >> np.uint64(o) & np.uint64((1 << n) - 1)).astype(np.int64) for o, n in SEGMENTS]
    keys, owners = [], []
    for k in range(3):
        near = fuzzy_keys(parts[(k + 1) % 3])
        owner, column = np.nonzero(near >= 0)
        keys.append(k << 40 | parts[k][owner] << 12 | near[owner, column])
        owners.append(owner)
    return np.concatenate(keys), np.concatenate(owners)


def _keyed(fps: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            for k in range(0, len(values), 2048):
                part = values[k : k + 2048]
                keys, owners = segment_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[owners])], names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key bigint, fp bigint")


def _midpoints(fps: DataFrame) -> DataFrame:
    """Each fingerprint with itself and its 64 one-bit flips."""
    flips = F.expr("transform(sequence(0, 63), b -> fp ^ shiftleft(1L, b))")
    return fps.select("fp", F.explode(F.array_append(flips, F.col("fp"))).alias("mid"))


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints exactly as all pairs within two bits would.

    Keys of few fingerprints are joined with themselves and verified. Fingerprints of a
    key with more are linked through midpoints: two fingerprints are within two bits if
    and only if they share a word within one flip of both, and a word has 65 such
    fingerprints at most. Work stays in proportion to the number of fingerprints, and no
    link is lost.
    """
    keyed = materialize(_keyed(fps), "simhash-keys")
    counts = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-counts")
    shared = materialize(keyed.join(counts, "key"), "simhash-shared")
    small = shared.where(F.col("n") <= PAIRWISE_LIMIT)
    left, right = small.select("key", F.col("fp").alias("a")), small.select("key", F.col("fp").alias("b"))
    pairs = (
        left.join(right, "key")
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE))
        .select("a", "b")
    )
    crowded = shared.where(F.col("n") > PAIRWISE_LIMIT).select("fp").distinct()
    stars = (
        _midpoints(crowded)
        .groupBy("mid")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
        .where("a != b")
    )
    return pairs.union(stars)


def simhash_groups(docs: DataFrame, n_words: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id, component, row_id.

    Fingerprints within two bits are linked; component_id is the smallest doc_id that
    links reach. A null or empty text has fingerprint zero and is linked like any other.
    Equal fingerprints become one node before any link is sought, so copies cost nothing
    beyond their own row, and the join back is a sort-merge join that the engine can
    split. Repeated rows give a row each. A null doc_id is never a component_id unless
    the whole component has none. Texts may be of any length. Other columns are ignored;
    an empty table gives an empty result. ``component`` is a number of the component that is never null, and
    ``row_id`` is ``monotonically_increasing_id()`` of the scanned row.
    """
    rows = materialize(fingerprints(docs, n_words), "simhash-rows")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash-nodes")
    linked = materialize(
        connected_components(fingerprint_links(nodes)).join(nodes.withColumnRenamed("fp", "node"), "node"), "simhash-linked"
    )
    named = linked.groupBy("root").agg(F.min("first_doc").alias("linked_doc"))
    classes = materialize(
        nodes.join(linked.select(F.col("node").alias("fp"), "root").join(named, "root"), "fp", "left").select(
            "fp", F.coalesce("linked_doc", "first_doc").alias("component_id"), F.coalesce("root", "fp").alias("component")
        ),
        "simhash-classes",
    )
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component", "row_id"
    )


def first_of_each_group(groups: DataFrame) -> DataFrame:
    """The row_id of one document of each component: smallest doc_id (null last), then smallest row_id."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))
    return groups.groupBy("component").agg(best.alias("best")).select(F.col("best.row_id").alias("row_id"))
