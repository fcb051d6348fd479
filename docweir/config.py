"""Settings from the environment, read on the driver only."""

from __future__ import annotations

import os
import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

# The settings that exist, the beginnings of names that are taken for settings, and the defaults.
KNOWN_KEYS = frozenset(
    {
        "LLM_BACKEND",
        "OPENAI_COMPAT_BASE_URL",
        "OPENAI_COMPAT_API_KEY",
        "OPENAI_COMPAT_MODEL",
        "JUDGE_RUNTIME",
        "RAGAS_BASE_URL",
        "RAGAS_API_KEY",
        "HF_TOKEN",
    }
)
PREFIXES = (
    "LLM_",
    "OPENAI_",
    "RAGAS_",
    "JUDGE_",
    "HF_",
    "HUGGING_",
    "EXTRACTOR_",
    "EMBED_",
    "LLMLITE_",
    "QDRANT_",
    "FALKORDB_",
    "PRIVATE_",
    "RETRIEVAL_",
    "SOVEREIGNTY_",
    "UNSTRUCTURED_",
    "CHUNK_",
    "DOCLING_",
    "SENSOR_",
)
DEFAULT_MODEL = "openai/gpt-oss-120b"
FALLBACK_MODELS = ("Qwen/Qwen2.5-32B-Instruct", "Qwen/Qwen2.5-14B-Instruct", "Qwen/Qwen2.5-7B-Instruct", "meta-llama/Llama-3.1-8B-Instruct")
EMBEDDING_MODEL, EMBEDDING_DIM = "BAAI/bge-m3", 1024
EMBEDDING_URL = "https://router.huggingface.co/hf-inference/models/{model}/pipeline/feature-extraction"
LOCAL_URL, CONTAINER_URL = "http://localhost:45857/v1", "http://llama:8080/v1"
REMOTE_BACKEND, LOCAL_BACKEND = "openai_compatible", "llama_cpp"

_warned = False


@dataclass(frozen=True)
class ModelSettings:
    """Where a language model is reached."""

    backend: str
    base_url: str
    api_key: str
    model: str

    def candidates(self, listed: str = "") -> list[str]:
        """Models to try in turn: this one, those listed with commas, the defaults; each once."""
        names = [self.model, *(x.strip() for x in listed.split(",")), *FALLBACK_MODELS]
        return list(dict.fromkeys(n for n in names if n))


def backend_name(given: str | None) -> str:
    """The remote backend if it is named in one of its spellings or nothing is, else the local one."""
    spelled = (given or REMOTE_BACKEND).strip().lower().replace("-", "_")
    return REMOTE_BACKEND if spelled in ("openai", REMOTE_BACKEND) else LOCAL_BACKEND


def local_url() -> str:
    return CONTAINER_URL if Path("/.dockerenv").exists() else LOCAL_URL


def unknown_keys(env: Mapping[str, str]) -> list[str]:
    """Names that look like settings but are none."""
    return sorted(k for k in env if (k == "API_KEY" or k.startswith(PREFIXES)) and k not in KNOWN_KEYS)


def warn_unknown_keys(env: Mapping[str, str] | None = None) -> None:
    """Warn of such names, once in a process."""
    global _warned
    if not _warned and (names := unknown_keys(os.environ if env is None else env)):
        warnings.warn("settings that nothing reads: " + ", ".join(names), RuntimeWarning, stacklevel=2)
    _warned = True


def model_settings(env: Mapping[str, str] | None = None, default_backend: str = REMOTE_BACKEND) -> ModelSettings:
    """Settings of the model; the remote backend needs an address and a key."""
    env = os.environ if env is None else env
    warn_unknown_keys(env)
    backend = backend_name(env.get("LLM_BACKEND", default_backend))
    model = (env.get("OPENAI_COMPAT_MODEL") or DEFAULT_MODEL).strip()
    if backend == LOCAL_BACKEND:
        return ModelSettings(backend, local_url(), "", model)
    url, key = ((env.get(k) or "").strip() for k in ("OPENAI_COMPAT_BASE_URL", "OPENAI_COMPAT_API_KEY"))
    for name, value in (("OPENAI_COMPAT_BASE_URL", url), ("OPENAI_COMPAT_API_KEY", key)):
        if not value:
            raise ValueError(f"{name} must be set for the backend {REMOTE_BACKEND}")
    return ModelSettings(backend, url.rstrip("/"), key, model)


def embedding_token(env: Mapping[str, str] | None = None) -> str:
    return ((os.environ if env is None else env).get("HF_TOKEN") or "").strip()
