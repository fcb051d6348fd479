"""Files, providers, manifests, settings and whole runs."""

import gc
import json
import os

import pytest
from pyspark.sql import functions as F

from docweir import cli, config
from docweir.operators.manifests import build_artifact_manifest, import_artifact_manifest, manifest_hash, source_root
from docweir.operators.models import embedded, embedding_cache
from docweir.operators.vectors import ensure_collection
from docweir.operators.keyed_table import KeyedTable
from docweir.plans.ingest import run_ingest, save_table
from docweir.sources.files import list_files, list_input_files, read_files, read_listed_files, utf8_text
from docweir.sources.parsers import ConverterParser, Element, PartitionParser, TextParser, element_segments, parse_failures, parsed_elements, parsed_segments
from docweir.sources.providers import GazetteerExtractor, HashingEmbedder, HttpEmbedder, HttpExtractor, coerced_vectors, post_json
from docweir.streaming.ingest import stream_chunks

MARKDOWN = "# Tomato blight\n\nWhy does tomato blight spread? Use copper spray.\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n![a leaf](leaf.png)\n\n$$x^2$$\n"


@pytest.fixture()
def corpus(tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    (root / "a.md").write_text(MARKDOWN, encoding="utf-8")
    (root / "sub/b.txt").write_bytes(b"copper spray helps tomato \xff\xfe plants")
    (root / ".hidden.txt").write_text("copper spray")
    (root / "empty.txt").write_text("")
    (root / "c.TXT").write_text("not listed")
    return root


def test_files(spark, corpus):
    (corpus / "_drafts").mkdir()
    (corpus / "_drafts/d 1.md").write_text("draft")
    listed = list_input_files(spark, corpus)
    assert listed == [(".hidden.txt", 12), ("empty.txt", 0), ("sub/b.txt", 35), ("_drafts/d 1.md", 5), ("a.md", len(MARKDOWN))]
    for root in (corpus, f"file://{corpus}/"):
        contents = {r.path: bytes(r.content) for r in read_listed_files(spark, root).collect()}
        assert contents == {n: (corpus / n).read_bytes() for n, _ in listed}
    assert list_input_files(spark, corpus / "none") == [] and read_listed_files(spark, corpus / "none").count() == 0
    assert {r.path for r in read_files(spark, corpus).collect()} == {"a.md", "sub/b.txt"}
    assert list_files(corpus / "none") == []
    texts = {r.path: r.t for r in read_files(spark, corpus).select("path", utf8_text(F.col("content")).alias("t")).collect()}
    assert texts["sub/b.txt"] == "copper spray helps tomato  plants"


def test_parsers(spark, corpus):
    class Broken:
        by_class = True

        def elements(self, path, content):
            raise RuntimeError("no such thing")

    class Items:
        by_class = True

        def elements(self, path, content):
            return [Element("", "PictureItem"), Element("", "TableItem", table_html="<t/>"), Element("m", "MathItem")]

    got = parsed_segments(read_files(spark, corpus).where("path = 'a.md'"), "offline").orderBy("seg_ord").collect()
    assert [(r.modality, r.asset_ref) for r in got] == [("text", None), ("text", None), ("table", "asset:2"), ("image", "asset:3"), ("formula", "asset:4")]
    assert got[2].text == "<table><tr><td>a</td><td>b</td></tr><tr><td>1</td><td>2</td></tr></table>" and got[4].text == "x^2"
    elements = parsed_elements(read_files(spark, corpus).where("path = 'a.md'"), [Broken(), Items()])
    assert [tuple(r) for r in parse_failures(elements).collect()] == [("a.md", "Broken", "RuntimeError: no such thing")]
    by_class = element_segments(elements).orderBy("seg_ord").collect()
    assert [(r.seg_ord, r.modality, r.text, r.asset_ref) for r in by_class] == [(1, "table", "<t/>", None), (2, "text", "m", None)]


def test_packages_are_given_the_content(spark, corpus, monkeypatch, tmp_path):
    """Both packages open what they are given, in a task whose working folder is another one."""
    monkeypatch.chdir(tmp_path)

    class Found:
        def __init__(self, text):
            self.text, self.category, self.metadata = text, "NarrativeText", None

    def partition(file, metadata_filename, **options):
        assert options["strategy"] == "hi_res"
        return [Found(f"{metadata_filename}: {len(file.read())} bytes")]

    class TextItem:
        def __init__(self, text):
            self.text = text

    class Converter:
        def convert(self, source):
            items = [(TextItem(f"{source.name} has {len(source.stream.read())}"), 0)]
            return type("Result", (), {"document": type("Document", (), {"iterate_items": lambda self: items})()})()

    files = read_files(spark, corpus).where("path = 'sub/b.txt'")
    assert parsed_segments(files, [PartitionParser(partition), TextParser()]).first().text == "sub/b.txt: 35 bytes"
    assert parsed_segments(files, [ConverterParser(Converter()), TextParser()]).first().text == "sub/b.txt has 35"
    failing = [PartitionParser(lambda **_: open("sub/b.txt")), TextParser()]
    elements = parsed_elements(files, failing)
    assert parse_failures(elements).first().error.startswith("FileNotFoundError") and "copper" in element_segments(elements).first().text


def test_saved_tables_are_read_back(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(500).selectExpr("CAST(id AS string) AS k", "id AS v")
    save_table(spark, rows, path, ["k"])
    save_table(spark, rows.where("k = '7'").withColumn("v", F.lit(-1).cast("long")).withColumn("more", F.lit("x")), path, ["k"])
    got = {r.k: (r.v, r.more) for r in KeyedTable(spark, path).read().collect()}
    assert len(got) == 500 and got["7"] == (-1, "x") and got["8"] == (8, None)
    save_table(spark, rows.limit(0), path, ["k"])
    assert KeyedTable(spark, path).read().count() == 500


def test_collection_contract(spark, tmp_path):
    path = str(tmp_path / "c.json")
    first = ensure_collection(spark, path, 16)
    assert first["vectors"]["dense_text"] == {"size": 16, "distance": "cosine"} and first["sparse_vectors"]["sparse"]["modifier"] == "idf"
    assert ensure_collection(spark, path, 16) == first
    with pytest.raises(ValueError):
        ensure_collection(spark, path, 8)


def test_exports():
    import docweir

    assert docweir.run_ingest is run_ingest and all(hasattr(docweir, n) for n in docweir.__all__)
    with pytest.raises(AttributeError):
        docweir.nothing


def test_connecting_and_reading_have_limits_of_their_own():
    import threading
    import time
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Slow(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            time.sleep(0.6)
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Slow)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/x"
    try:
        assert post_json(url, {"a": 1}, {}, (0.2, 10.0)) == {"a": 1}
        with pytest.raises(OSError):
            post_json(url, {"a": 1}, {}, (10.0, 0.2))
    finally:
        server.shutdown()


def test_ingest_twice(spark, corpus, tmp_path):
    names = {"Tomato": "Crop", "copper spray": "Practice", "blight": "Disease", "banana": "Planet"}
    run = dict(
        extractor=GazetteerExtractor(names), embedder=HashingEmbedder(16), parser="offline", ontology_path=tmp_path / "o.json", created_at="t0", output_dir=str(tmp_path / "out")
    )
    first = run_ingest(spark, corpus, **run)
    assert first.totals["chunks"] == 7 and first.totals["entities"] >= 5
    assert first.ontology["allowed_entity_labels"] == ["Crop", "Disease", "Practice"]
    assert first.ontology["relation_hint_tokens"]["en"] == ["why"]
    assert "chunks=7" in first.summary() and first.failures.count() == 0
    tables = ("vector_points", "g_chunk", "g_document", "g_has_chunk", "g_entity", "g_mentions", "g_relation")
    counts = {t: KeyedTable(spark, f"{tmp_path}/out/{t}").read().count() for t in tables}
    assert counts["vector_points"] == 7 and counts["g_document"] == 3 and counts["g_entity"] == 3
    run_ingest(spark, corpus, **run)
    assert {t: KeyedTable(spark, f"{tmp_path}/out/{t}").read().count() for t in tables} == counts
    point = KeyedTable(spark, f"{tmp_path}/out/vector_points").read().where("modality = 'image'").first()
    assert len(point.dense_text) == 16 and point.dense_text != point.dense_image and point.canonical_doc_id == "a.md"


def test_streamed_chunks(spark, corpus, tmp_path):
    for _ in range(2):
        stream_chunks(spark, str(corpus), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert KeyedTable(spark, f"{tmp_path}/out/chunks").read().count() == 6


def test_export_and_import(spark, tmp_path):
    index = tmp_path / "index"
    (index / "d").mkdir(parents=True)
    (index / "d/x.bin").write_bytes(b"x" * 3_000_000)
    (index / ".y").write_text("y")
    path = build_artifact_manifest(spark, {"vectors": {"root": index}, "graph": {"root": tmp_path / "none", "graph_name": "g"}}, tmp_path / "out", "m")
    manifest = json.loads(path.read_text())
    assert manifest["manifest_sha256"] == manifest_hash(manifest)
    assert [f["path"] for f in manifest["artifacts"]["vectors"]["files"]] == [".y", "d/x.bin"]
    assert manifest["artifacts"]["graph"]["file_count"] == 0
    done = import_artifact_manifest(spark, path, {"vectors": tmp_path / "copy"}, verify_manifest=True)
    assert done["vectors"]["copied_files"] == 2 and (tmp_path / "copy/d/x.bin").read_bytes() == b"x" * 3_000_000
    (index / "d/x.bin").write_bytes(b"z")
    with pytest.raises(Exception, match="the manifest states"):
        import_artifact_manifest(spark, path, {"vectors": tmp_path / "copy"})
    import_artifact_manifest(spark, path, {"vectors": tmp_path / "copy"}, verify=False)
    with pytest.raises(FileNotFoundError):
        source_root(None, str(tmp_path / "gone"), tmp_path / "gone too")
    manifest["artifacts"]["vectors"]["files"] = [{"path": "../out/artifact_manifest.json"}]
    path.write_text(json.dumps(manifest))
    with pytest.raises(Exception, match="leads out"):
        import_artifact_manifest(spark, path, {"vectors": tmp_path / "copy"})


def test_repro_check(spark, corpus, tmp_path, capsys):
    out = tmp_path / "m.json"
    assert cli.repro_check(["--input-dir", str(corpus), "--out", str(out), "--parser", "text"]) == 0
    first = json.loads(out.read_text())
    assert first["file_count"] == 4 and len(first["files"]) == 3
    same = ["--input-dir", str(corpus), "--out", str(tmp_path / "n.json"), "--parser", "text", "--compare-manifest", str(out)]
    assert cli.repro_check(same) == 0
    (corpus / "sub/b.txt").write_text("changed")
    assert cli.repro_check(same) == 3
    assert "[FAIL]" in capsys.readouterr().err


def test_repro_check_with_extraction(spark, corpus, tmp_path):
    names = tmp_path / "names.json"
    names.write_text(json.dumps({"Tomato": "Crop", "copper spray": "Practice"}))
    plain, full = tmp_path / "plain.json", tmp_path / "full.json"
    given = ["--input-dir", str(corpus), "--parser", "text", "--ontology", str(tmp_path / "none.json")]
    assert cli.repro_check([*given, "--out", str(plain)]) == 0
    model = ["--include-extractor", "--offline", "--gazetteer", str(names)]
    assert cli.repro_check([*given, "--out", str(full), *model]) == 0
    assert cli.repro_check([*given, "--out", str(tmp_path / "again.json"), *model, "--compare-manifest", str(full)]) == 0
    a, b = (json.loads(p.read_text()) for p in (plain, full))
    assert (a["include_extractor"], a["entity_total"]) == (False, 0) and b["include_extractor"] and b["entity_total"] == 5 and b["relation_total"] == 2
    assert a["files"]["a.md"]["chunk_digests"] != b["files"]["a.md"]["chunk_digests"]


def test_vectors_of_a_service(spark):
    assert coerced_vectors([1, 2], 1) == [[1.0, 2.0]]
    for body, n in (([1, 2], 2), ([[1], [2]], 3), ("x", 1), ([["x"]], 1), ([], 0)):
        with pytest.raises(RuntimeError):
            coerced_vectors(body, n)
    calls = []

    def flaky(url, body, headers, timeout):
        calls.append(body)
        if len(calls) < 3:
            raise OSError("busy")
        return [[0.0, 1.0] for _ in body["inputs"]]

    assert HttpEmbedder("key", dim=2, post=flaky).embed(["a", "b"]) == [[0.0, 1.0]] * 2 and len(calls) == 3
    with pytest.raises(RuntimeError):
        HttpEmbedder(post=lambda *a: {}).embed(["a"])


def test_each_text_is_embedded_once(spark):
    texts = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("",)], "text string")
    got = embedded(texts, HashingEmbedder(8))
    assert got.count() == 3
    assert embedded(texts.union(spark.createDataFrame([("c",)], "text string")), HashingEmbedder(8), got).count() == 4


def test_vectors_leave_a_task_request_by_request(spark):
    class Vector(list):
        pass

    class CountingEmbedder(HashingEmbedder):
        """Fails if vectors of many requests are Python objects at once."""

        def embed(self, texts):
            alive = sum(type(x) is Vector for x in gc.get_objects())
            if alive > 40:
                raise MemoryError(f"{alive} vectors")
            return [Vector(v) for v in super().embed(texts)]

    texts = spark.createDataFrame([(f"a b{k}",) for k in range(995)], "text string").coalesce(1)
    got = {r.text_hash: r.vector for r in embedded(texts, CountingEmbedder(8, batch_size=10)).collect()}
    assert got == {r.text_hash: r.vector for r in embedded(texts, HashingEmbedder(8)).collect()} and len(got) == 995


def test_answered_requests_outlive_a_failure(spark, tmp_path):
    class BreakingEmbedder(HashingEmbedder):
        """Notes what it is asked for, and fails on one text while a file is there."""

        batch_size = 1

        def __init__(self, dim, log, broken):
            super().__init__(dim)
            self.log, self.broken = str(log), str(broken)

        def embed(self, texts):
            if "bad" in texts and os.path.exists(self.broken):
                raise OSError("the service is gone")
            with open(self.log, "a") as f:
                f.writelines(t + "\n" for t in texts)
            return super().embed(texts)

    texts = spark.createDataFrame([(f"t{k}",) for k in range(20)] + [("bad",)], "text string").repartition(3)
    log, broken = tmp_path / "log", tmp_path / "broken"
    log.write_text("")
    broken.write_text("")
    embedder = BreakingEmbedder(8, log, broken)
    cache = embedding_cache(spark, str(tmp_path / "cache"))
    with pytest.raises(RuntimeError, match="OSError: the service is gone"):
        embedded(texts, embedder, cache)
    first = log.read_text().split()
    assert len(first) == len(set(first)) == cache.read().count() and "bad" not in first
    broken.unlink()
    got = embedded(texts, embedder, cache)
    assert got.count() == 21 and cache.read().count() == 21
    asked = log.read_text().split()
    assert sorted(asked) == sorted({f"t{k}" for k in range(20)} | {"bad"})
    # Another model has vectors of its own.
    assert embedded(texts.limit(2), HashingEmbedder(8), cache).count() == 2 and len(log.read_text().split()) == 21


def test_models_are_tried_in_turn():
    seen = []

    def post(url, body, headers, timeout):
        seen.append((body["model"], headers.get("Authorization")))
        if len(seen) < 2:
            raise OSError("down")
        return {"choices": [{"message": {"content": "{}"}}]}

    settings = config.ModelSettings("openai_compatible", "http://x/v1", "k", "first")
    reply = HttpExtractor(settings, post=post).reply("p", "t")
    assert (reply.content, reply.model) == ("{}", config.FALLBACK_MODELS[0]) and seen[0] == ("first", "Bearer k")
    assert "first" in HttpExtractor(settings, ["first"], post=lambda *a: 1 / 0).reply("p", "t").error
    assert settings.candidates(" second ,first,") == ["first", "second", *config.FALLBACK_MODELS]


def test_settings(monkeypatch):
    assert config.backend_name(" OpenAI-compatible ") == "openai_compatible" and config.backend_name("vllm") == "llama_cpp"
    with pytest.raises(ValueError, match="BASE_URL"):
        config.model_settings({})
    with pytest.raises(ValueError, match="API_KEY"):
        config.model_settings({"OPENAI_COMPAT_BASE_URL": "http://x/"})
    remote = config.model_settings({"OPENAI_COMPAT_BASE_URL": "http://x/", "OPENAI_COMPAT_API_KEY": "k"})
    assert remote.base_url == "http://x" and remote.model == config.DEFAULT_MODEL
    assert config.model_settings({"LLM_BACKEND": "llama"}).api_key == ""
    monkeypatch.setattr(config, "_warned", False)
    with pytest.warns(RuntimeWarning, match="EMBED_X"):
        config.warn_unknown_keys({"EMBED_X": "1", "HF_TOKEN": "t", "HOME": "/"})


@pytest.mark.parametrize("names", [[], ["b.md"], ["b.md", "a/딸기.txt", "a-b.md", "a/b.md", "\U0001f600.md", "～.md"]])
def test_streamed_manifest_is_that_of_the_whole(spark, tmp_path, names):
    import hashlib
    import io

    from docweir.operators.manifests import stable_json, stream_repro_manifest

    rows = [(n, k + 1, 2 * k, k, [f"{n}{i}" for i in range(k + 1)]) for k, n in enumerate(names)]
    rollup = spark.createDataFrame(rows, "path string, chunks long, entities long, relations long, chunk_digests array<string>").repartition(3)
    out = io.StringIO()
    head = stream_repro_manifest(rollup, tmp_path, 9, out, True)
    written = json.loads(out.getvalue())
    core = {
        "input_dir": str(tmp_path.resolve()), "include_extractor": True, "file_count": 9,
        "chunk_total": sum(r[1] for r in rows), "entity_total": sum(r[2] for r in rows), "relation_total": sum(r[3] for r in rows),
        "files": {r[0]: dict(zip(("chunks", "entities", "relations", "chunk_digests"), r[1:])) for r in sorted(rows)},
    }
    located = hashlib.sha256(stable_json(core).encode()).hexdigest()
    free = hashlib.sha256(stable_json({k: v for k, v in core.items() if k != "input_dir"}).encode()).hexdigest()
    whole = core | {"manifest_sha256": located, "content_sha256": free}
    assert written == whole and list(written["files"]) == sorted(names) and out.getvalue() == json.dumps(whole, ensure_ascii=False, indent=2)
    assert head == {k: v for k, v in whole.items() if k != "files"}
