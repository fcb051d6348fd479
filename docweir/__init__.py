"""A PySpark-native engine for document ingest and training data.

The names in ``__all__`` are loaded when first used, so that importing the package needs
neither Spark nor a model's client.
"""

from importlib import import_module

_HOMES = {
    "IngestResult": "docweir.plans.ingest",
    "run_ingest": "docweir.plans.ingest",
    "save_table": "docweir.plans.ingest",
    "repro_run": "docweir.plans.repro",
    "stream_chunks": "docweir.streaming.ingest",
    "read_listed_files": "docweir.sources.files",
    "parsed_segments": "docweir.sources.parsers",
    "HttpEmbedder": "docweir.sources.providers",
    "HttpExtractor": "docweir.sources.providers",
    "chunk_segments": "docweir.operators.chunking",
    "chunk_texts": "docweir.operators.chunking",
    "sparse_vectors": "docweir.operators.vectors",
    "dense_vectors": "docweir.operators.models",
    "Ontology": "docweir.operators.ontology",
    "load_ontology": "docweir.operators.ontology",
    "build_ontology": "docweir.operators.ontology",
    "build_artifact_manifest": "docweir.operators.manifests",
    "import_artifact_manifest": "docweir.operators.manifests",
}
__all__ = sorted(_HOMES)


def __getattr__(name: str):
    if name not in _HOMES:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(_HOMES[name]), name)
