"""Checksums: artifact manifests, verified copies and reproducibility digests."""

from __future__ import annotations

import hashlib
import io
import json
import os
import shutil
from datetime import datetime, timezone
from pathlib import Path
from typing import TextIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docweir.sources.files import list_files
from docweir.storage import materialize

BLOCK = 1 << 20
MANIFEST_NAME = "artifact_manifest.json"


def stable_json(value) -> str:
    """Compact JSON with sorted keys, so that equal values have equal text."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def text_sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def file_sha256(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def described_files(spark: SparkSession, root: str | Path, names: list[str]) -> DataFrame:
    """(path, size_bytes, sha256) of files under a root that all executors see; hashed in blocks where the task runs."""
    base = str(Path(root).resolve())

    def run(batches):
        for pdf in batches:
            full = [os.path.join(base, p) for p in pdf["path"]]
            yield pdf.assign(size_bytes=[os.path.getsize(p) for p in full], sha256=[file_sha256(p) for p in full])[["path", "size_bytes", "sha256"]]

    listed = spark.createDataFrame([(n,) for n in names], "path string")
    return listed.repartition(max(1, min(len(names), spark.sparkContext.defaultParallelism))).mapInPandas(
        run, "path string, size_bytes bigint, sha256 string"
    )


def content_digests(files: DataFrame) -> DataFrame:
    """(path, size_bytes, sha256) of rows with binary ``content``, without Python."""
    return files.select("path", F.octet_length("content").cast("bigint").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def build_artifact_manifest(spark: SparkSession, blocks: dict[str, dict], output_dir: str | Path, model_id: str) -> Path:
    """Write the manifest of artifact folders and return its path.

    ``blocks`` maps a name to ``{"root": folder, ...}``; further keys are kept. A missing
    folder has no files. The manifest's own hash covers its text without that field.
    """
    artifacts = {}
    for name, block in blocks.items():
        names = list_files(block["root"])
        rows = {r.path: r.asDict() for r in described_files(spark, block["root"], names).collect()} if names else {}
        artifacts[name] = {**block, "root": str(block["root"]), "file_count": len(names), "files": [rows[n] for n in names]}
    manifest = {
        "created_at": datetime.now(timezone.utc).isoformat(),
        "artifacts": artifacts,
        "runtime": {"embedding_model": model_id},
    }
    manifest["manifest_sha256"] = manifest_hash(manifest)
    target = Path(output_dir)
    target.mkdir(parents=True, exist_ok=True)
    path = target / MANIFEST_NAME
    path.write_text(json.dumps(manifest, ensure_ascii=False, indent=2), encoding="utf-8")
    return path


def manifest_hash(manifest: dict) -> str:
    """Of the indented JSON without the hash itself."""
    return text_sha256(json.dumps({k: v for k, v in manifest.items() if k != "manifest_sha256"}, ensure_ascii=False, indent=2))


def source_root(explicit: str | Path | None, recorded: str, fallback: Path) -> Path:
    """The folder given, else the one recorded if it exists, else the one beside the manifest."""
    if explicit:
        return Path(explicit)
    for candidate in (Path(recorded).expanduser() if recorded else Path("."), fallback):
        if candidate.exists():
            return candidate.resolve()
    raise FileNotFoundError(f"no source folder: neither {recorded!r} nor {fallback} exists")


def _inside(root: Path, name: str) -> Path:
    path = (root / name).resolve()
    if not path.is_relative_to(root.resolve()):
        raise ValueError(f"{name!r} leads out of {root}")
    return path


def copy_verified(spark: SparkSession, source: Path, target: Path, entries: list[dict], verify: bool = True) -> tuple[int, int]:
    """Copy a manifest's files where the executors see both folders; (files, bytes).

    A missing file or a wrong checksum raises; files copied before stay. A blank path is
    skipped, an empty checksum isn't checked, and a path that leaves either folder raises.
    """
    rows = [(str(e.get("path") or "").strip().replace("\\", "/"), str(e.get("sha256") or "").strip().lower()) for e in entries]
    rows = [r for r in rows if r[0]]
    target.mkdir(parents=True, exist_ok=True)
    if not rows:
        return 0, 0

    def run(batches):
        for pdf in batches:
            sizes = []
            for name, expected in zip(pdf["path"], pdf["sha256"], strict=True):
                src, dst = _inside(source, name), _inside(target, name)
                if not src.is_file():
                    raise FileNotFoundError(f"{src} is in the manifest, but there is no such file")
                if verify and expected and (got := file_sha256(src)) != expected:
                    raise ValueError(f"{src} has the checksum {got}, where the manifest states {expected}")
                dst.parent.mkdir(parents=True, exist_ok=True)
                shutil.copy2(src, dst)
                sizes.append(dst.stat().st_size)
            yield pdf.assign(size=sizes)[["size"]]

    listed = spark.createDataFrame(rows, "path string, sha256 string").repartition(min(len(rows), spark.sparkContext.defaultParallelism))
    done = listed.mapInPandas(run, "size bigint").agg(F.count("size"), F.sum("size")).first()
    return done[0], done[1]


def import_artifact_manifest(
    spark: SparkSession,
    manifest_path: str | Path,
    targets: dict[str, str | Path],
    sources: dict[str, str | Path] | None = None,
    verify: bool = True,
    verify_manifest: bool = False,
) -> dict:
    """Copy the files of each block of a manifest to its target folder and say what was done."""
    path = Path(manifest_path)
    manifest = json.loads(path.read_text(encoding="utf-8"))
    if verify_manifest and manifest.get("manifest_sha256") != manifest_hash(manifest):
        raise ValueError("the manifest doesn't have the hash that it states")
    blocks = manifest.get("artifacts") or {}
    roots = {n: source_root((sources or {}).get(n), str((blocks.get(n) or {}).get("root") or ""), path.parent / n) for n in targets}
    out: dict = {"manifest_path": str(path), "verify_sha256": verify, "runtime": manifest.get("runtime") or {}}
    for name, target in targets.items():
        files = (blocks.get(name) or {}).get("files")
        count, size = copy_verified(spark, roots[name], Path(target), files if isinstance(files, list) else [], verify)
        out[name] = {"source_root": str(roots[name]), "target_root": str(target), "copied_files": count, "copied_bytes": size}
    return out


METADATA = ["source_doc", "modality", "asset_ref", "table_html_ref", "formula_latex_ref", "image_b64_ref"]


@F.pandas_udf(StringType())
def _digest(rows):
    """SHA-256 of the stable JSON of a chunk; its numbers and escapes have no equal in the built-in JSON functions."""

    def plain(value):
        if isinstance(value, dict):
            return {k: plain(v) for k, v in value.items()}
        if hasattr(value, "tolist"):
            value = value.tolist()
        return [plain(v) for v in value] if isinstance(value, list) else value

    records = rows.to_dict("records")
    return rows.assign(_digest=[text_sha256(stable_json(plain(r))) for r in records])["_digest"]


def chunk_digests(chunks: DataFrame, entities: DataFrame | None = None, relations: DataFrame | None = None, key: str = "chunk_id") -> DataFrame:
    """Chunks with ``digest``, over id, text, metadata and what was extracted from them (nothing, by default).

    ``key`` names the column of the chunks that the chunk_id of entities and relations means.
    """
    entity = "array<struct<text:string,type:string,canonical_id:string,confidence:double>>"
    relation = "array<struct<source:string,target:string,type:string,confidence:double,evidence:string>>"
    out = chunks
    for name, df, kind in (("_entities", entities, entity), ("_relations", relations, relation)):
        if df is None:
            out = out.withColumn(name, F.from_json(F.lit("[]"), kind))
            continue
        fields = [f.split(":")[0] for f in kind[len("array<struct<") : -2].split(",")]
        listed = df.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("ord", F.struct(*fields).alias("_i")))).alias("_l"))
        out = out.join(listed.select(F.col("chunk_id").alias("_of"), F.col("_l._i").alias(name)), F.col(key) == F.col("_of"), "left").drop("_of")
        out = out.withColumn(name, F.coalesce(name, F.from_json(F.lit("[]"), kind)))
    whole = F.struct(
        "chunk_id",
        "text",
        F.struct(*METADATA).alias("metadata"),
        F.col("_entities").alias("entities"),
        F.col("_relations").alias("relations"),
    )
    return out.withColumn("digest", _digest(whole)).withColumns(
        {"n_entities": F.size("_entities").cast("bigint"), "n_relations": F.size("_relations").cast("bigint")}
    ).drop("_entities", "_relations")


def repro_rollup(digests: DataFrame) -> DataFrame:
    """(path, chunks, entities, relations, chunk_digests): per file, its digests in order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "digest"))), lambda d: d.digest)
    return digests.groupBy("path").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.sum("n_entities").alias("entities"),
        F.sum("n_relations").alias("relations"),
        listed.alias("chunk_digests"),
    )


def stream_repro_manifest(rollup: DataFrame, input_dir: str | Path, file_count: int, out: TextIO, include_extractor: bool = False) -> dict:
    """Write the manifest of a run to ``out`` as indented JSON, and return it without its files.

    The hash is that of the stable JSON, whose text is fed to it piece by piece in the
    order of its keys, so files come to the driver one after the other, sorted by path,
    and are never held together. Besides the hash with the place of the input there is
    one without.
    """
    files = materialize(rollup, "repro-files")
    sums = files.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("chunks", "entities", "relations")]).first()
    head = {
        "input_dir": str(Path(input_dir).resolve()),
        "include_extractor": include_extractor,
        "file_count": file_count,
        "chunk_total": sums.chunks,
        "entity_total": sums.entities,
        "relation_total": sums.relations,
    }
    located, free = hashlib.sha256(), hashlib.sha256()

    def hashed(text: str) -> None:
        for h in (located, free):
            h.update(text.encode("utf-8"))

    def items(keys: list[str]) -> str:
        return ",".join(f"{stable_json(k)}:{stable_json(head[k])}" for k in keys)

    before, after = (sorted(k for k in head if (k < "files") is first) for first in (True, False))
    out.write(json.dumps(head, ensure_ascii=False, indent=2)[:-2] + ',\n  "files": {')
    hashed("{" + items(before) + ',"files":{')
    n = 0
    for row in files.orderBy("path").toLocalIterator():
        entry = {"chunks": row.chunks, "entities": row.entities, "relations": row.relations, "chunk_digests": list(row.chunk_digests)}
        hashed(f"{',' if n else ''}{stable_json(row.path)}:{stable_json(entry)}")
        shown = json.dumps(entry, ensure_ascii=False, indent=2).replace("\n", "\n    ")
        out.write(f"{',' if n else ''}\n    {json.dumps(row.path, ensure_ascii=False)}: {shown}")
        n += 1
    located.update(("}," + items(after) + "}").encode("utf-8"))
    free.update(("}," + items([k for k in after if k != "input_dir"]) + "}").encode("utf-8"))
    hashes = {"manifest_sha256": located.hexdigest(), "content_sha256": free.hexdigest()}
    out.write(("\n  " if n else "") + "},\n" + json.dumps(hashes, indent=2)[2:])
    return head | hashes


def repro_manifest(rollup: DataFrame, input_dir: str | Path, file_count: int, include_extractor: bool = False) -> dict:
    """The manifest of a run as a whole, for inputs of moderate size."""
    out = io.StringIO()
    stream_repro_manifest(rollup, input_dir, file_count, out, include_extractor)
    return json.loads(out.getvalue())


def same_manifest(ours: dict, other_path: str | Path) -> bool:
    other = json.loads(Path(other_path).read_text(encoding="utf-8"))
    return str(other.get("manifest_sha256") or "") == str(ours.get("manifest_sha256") or "")
