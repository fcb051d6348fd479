"""Embedding and language models behind small interfaces; offline stand-ins are no substitute for real models."""

from __future__ import annotations

import hashlib
import http.client
import json
import math
import re
import urllib.request
from dataclasses import dataclass, field
from typing import Protocol

from docweir.config import EMBEDDING_DIM, EMBEDDING_MODEL, EMBEDDING_URL, ModelSettings


class Embedder(Protocol):
    """Vectors of texts, in order. Objects are sent to the tasks."""

    model: str
    dim: int
    batch_size: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class Extractor(Protocol):
    """A model's reply to a prompt."""

    def reply(self, prompt: str, text: str) -> Reply: ...


@dataclass
class Reply:
    content: str = ""
    model: str = ""
    error: str = ""


def _connection(kind: type, read: float) -> type:
    """A connection that waits for an answer as long as ``read`` says, however long it may wait to be made."""

    class Connection(kind):
        def connect(self) -> None:
            super().connect()
            self.sock.settimeout(read)

    return Connection


class _Http(urllib.request.HTTPHandler):
    def __init__(self, read: float) -> None:
        super().__init__()
        self.read = read

    def http_open(self, request):
        return self.do_open(_connection(http.client.HTTPConnection, self.read), request)


class _Https(urllib.request.HTTPSHandler):
    def __init__(self, read: float) -> None:
        super().__init__()
        self.read = read

    def https_open(self, request):
        return self.do_open(_connection(http.client.HTTPSConnection, self.read), request, context=self._context)


def post_json(url: str, body: dict, headers: dict[str, str], timeout: tuple[float, float]) -> object:
    """The JSON answer to a JSON request; ``timeout`` has the seconds to connect and to wait for the answer."""
    connect, read = timeout
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    with urllib.request.build_opener(_Http(read), _Https(read)).open(request, timeout=connect) as response:
        return json.loads(response.read())


def coerced_vectors(body: object, expected: int) -> list[list[float]]:
    """A service's answer as one vector per text; one flat vector is right for one text only."""
    number = (int, float)
    if not isinstance(body, list) or not body:
        raise RuntimeError("an embedding service must answer with a list of numbers or of vectors")
    rows = [body] if isinstance(body[0], number) else body
    if not all(isinstance(r, list) and (not r or isinstance(r[0], number)) for r in rows):
        raise RuntimeError("an embedding service must answer with a list of numbers or of vectors")
    if len(rows) != expected:
        raise RuntimeError(f"{expected} vectors were expected and {len(rows)} came")
    return [[float(x) for x in r] for r in rows]


@dataclass
class HttpEmbedder:
    """A feature-extraction service; any failure is tried again ``retries`` times without waiting."""

    token: str = ""
    model: str = EMBEDDING_MODEL
    dim: int = EMBEDDING_DIM
    batch_size: int = 8
    retries: int = 2
    timeout: tuple[float, float] = (5.0, 30.0)
    url: str = ""
    post: object = post_json

    def embed(self, texts: list[str]) -> list[list[float]]:
        headers = {"Authorization": f"Bearer {self.token}"} if self.token else {}
        failure: Exception | None = None
        for _ in range(self.retries + 1):
            try:
                body = self.post(self.url or EMBEDDING_URL.format(model=self.model), {"inputs": texts}, headers, self.timeout)
                return coerced_vectors(body, len(texts))
            except Exception as e:  # noqa: BLE001  whatever fails is tried again
                failure = e
        raise RuntimeError(f"embedding failed: {failure}") from failure


@dataclass
class HashingEmbedder:
    """Offline: unit vectors from hashed words. They say nothing about meaning."""

    dim: int = EMBEDDING_DIM
    model: str = "offline-hashing"
    batch_size: int = 256

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * self.dim
            for word in text.lower().split():
                h = hashlib.md5(word.encode()).hexdigest()
                v[int(h[:8], 16) % self.dim] += 1.0 if h[8] < "8" else -1.0
            norm = math.sqrt(math.fsum(x * x for x in v))
            out.append([x / norm for x in v] if norm else [1.0] + v[1:])
        return out


@dataclass
class HttpExtractor:
    """A chat-completions service; the next model is tried when one fails, not when its reply can't be read."""

    settings: ModelSettings
    models: list[str] = field(default_factory=list)
    timeout: tuple[float, float] = (8.0, 45.0)
    max_tokens: int = 1024
    temperature: float = 0.0
    referer: str = ""
    title: str = ""
    post: object = post_json

    def headers(self) -> dict[str, str]:
        given = {"Authorization": self.settings.api_key and f"Bearer {self.settings.api_key}", "HTTP-Referer": self.referer, "X-Title": self.title}
        return {k: v for k, v in given.items() if v}

    def reply(self, prompt: str, text: str) -> Reply:
        failures = []
        for model in self.models or self.settings.candidates():
            body = {
                "model": model,
                "messages": [{"role": "user", "content": prompt}],
                "temperature": self.temperature,
                "max_tokens": self.max_tokens,
                "response_format": {"type": "json_object"},
            }
            try:
                answer = self.post(f"{self.settings.base_url}/chat/completions", body, self.headers(), self.timeout)
                message = ((answer or {}).get("choices") or [{}])[0].get("message", {})
                return Reply(str(message.get("content") or ""), model)
            except Exception as e:  # noqa: BLE001  whatever fails passes the prompt to the next model
                failures.append(f"{model}: {e}")
        return Reply(error="; ".join(failures))


@dataclass
class GazetteerExtractor:
    """Offline: known names found in a text, and links between neighbours. No model quality is implied."""

    names: dict[str, str]
    relation: str = "MENTIONS"

    def reply(self, prompt: str, text: str) -> Reply:
        found = sorted((m.start(), n) for n in self.names for m in re.finditer(rf"(?i)(?<!\w){re.escape(n)}(?!\w)", text))
        names = list(dict.fromkeys(n for _, n in found))
        ids = {n: re.sub(r"\W+", "_", n.lower()) for n in names}
        entities = [{"text": n, "type": self.names[n], "canonical_id": ids[n], "confidence": 0.9} for n in names]
        links = [{"source": ids[a], "target": ids[b], "type": self.relation, "confidence": 0.5, "evidence": f"{a} {b}"} for a, b in zip(names, names[1:], strict=False)]
        return Reply(json.dumps({"entities": entities, "relations": links}, ensure_ascii=False), "offline-gazetteer")


#: By name, what makes an embedder from keyword arguments.
EMBEDDERS = {"http": HttpEmbedder, "hashing": HashingEmbedder}
