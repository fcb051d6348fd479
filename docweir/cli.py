"""Command lines: public-ingest, artifact-export, artifact-import and repro-check."""

from __future__ import annotations

import argparse
import json
import shutil
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from docweir.config import EMBEDDING_MODEL, embedding_token, model_settings
from docweir.operators.manifests import build_artifact_manifest, import_artifact_manifest, same_manifest
from docweir.operators.ontology import load_ontology
from docweir.plans.ingest import run_ingest
from docweir.plans.repro import write_repro_run
from docweir.sources.parsers import CHAINS
from docweir.sources.providers import Extractor, GazetteerExtractor, HashingEmbedder, HttpEmbedder, HttpExtractor


def _session() -> SparkSession:
    return SparkSession.builder.appName("docweir").getOrCreate()


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(v.split("=", 1) for v in values)


def _extractor(offline: bool, gazetteer: str) -> Extractor:
    names = json.loads(Path(gazetteer).read_text(encoding="utf-8")) if gazetteer else {}
    return GazetteerExtractor(names) if offline else HttpExtractor(model_settings())


def public_ingest(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="public-ingest", description="Files to chunks, vectors and graph tables")
    p.add_argument("--input-dir", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--ontology", default="domain_ontology.json")
    p.add_argument("--parser", choices=sorted(CHAINS), default="auto")
    p.add_argument("--offline", action="store_true", help="stand-ins instead of models")
    p.add_argument("--gazetteer", default="", help="JSON object of names and their types, for --offline")
    args = p.parse_args(argv)
    result = run_ingest(
        _session(),
        args.input_dir,
        extractor=_extractor(args.offline, args.gazetteer),
        embedder=HashingEmbedder() if args.offline else HttpEmbedder(embedding_token()),
        parser=args.parser,
        ontology_path=args.ontology,
        output_dir=args.output_dir,
    )
    print(result.summary())
    return 0


def artifact_export(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="artifact-export", description="Checksum manifest of artifact folders")
    p.add_argument("--artifact", action="append", default=[], metavar="NAME=DIR", help="a folder to list; can be repeated")
    p.add_argument("--graph", default="", metavar="NAME=GRAPH", help="the graph name of one artifact")
    p.add_argument("--output-dir", default="output")
    p.add_argument("--model-id", default=EMBEDDING_MODEL)
    args = p.parse_args(argv)
    graphs = _pairs([args.graph]) if args.graph else {}
    blocks = {n: {"root": d} | ({"graph_name": graphs[n]} if n in graphs else {}) for n, d in _pairs(args.artifact).items()}
    print(build_artifact_manifest(_session(), blocks, args.output_dir, args.model_id))
    return 0


def artifact_import(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="artifact-import", description="Verified copy of a manifest's files")
    p.add_argument("--manifest", required=True)
    p.add_argument("--target", action="append", default=[], metavar="NAME=DIR")
    p.add_argument("--source", action="append", default=[], metavar="NAME=DIR")
    p.add_argument("--skip-sha256-check", action="store_true")
    p.add_argument("--verify-manifest", action="store_true")
    args = p.parse_args(argv)
    done = import_artifact_manifest(
        _session(), args.manifest, _pairs(args.target), _pairs(args.source), not args.skip_sha256_check, args.verify_manifest
    )
    print(json.dumps(done, ensure_ascii=False, indent=2))
    return 0


def repro_check(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="repro-check", description="Digest manifest of what the inputs give")
    p.add_argument("--input-dir", required=True)
    p.add_argument("--out", default="output/repro/manifest.json")
    p.add_argument("--compare-manifest", default="")
    p.add_argument("--parser", choices=sorted(CHAINS), default="auto")
    p.add_argument("--include-extractor", action="store_true", help="let a model read each chunk and cover what it finds")
    p.add_argument("--ontology", default="domain_ontology.json")
    p.add_argument("--offline", action="store_true", help="a stand-in instead of a model")
    p.add_argument("--gazetteer", default="", help="JSON object of names and their types, for --offline")
    args = p.parse_args(argv)
    # Only a run that asks a model needs its settings.
    extractor = _extractor(args.offline, args.gazetteer) if args.include_extractor else None
    out = Path(args.out)
    out.parent.mkdir(parents=True, exist_ok=True)
    with out.open("w", encoding="utf-8") as f:
        manifest = write_repro_run(_session(), args.input_dir, f, args.parser, extractor, load_ontology(args.ontology))
    with out.open(encoding="utf-8") as f:
        shutil.copyfileobj(f, sys.stdout)
    print()
    agrees = not args.compare_manifest or same_manifest(manifest, args.compare_manifest)
    if not agrees:
        print(f"[FAIL] {args.input_dir} doesn't give what {args.compare_manifest} states", file=sys.stderr)
    return 0 if agrees else 3


COMMANDS = {"public-ingest": public_ingest, "artifact-export": artifact_export, "artifact-import": artifact_import, "repro-check": repro_check}

if __name__ == "__main__":
    sys.exit(COMMANDS[sys.argv[1]](sys.argv[2:]))
