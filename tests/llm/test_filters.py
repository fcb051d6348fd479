"""Classifiers: what they learn, what they never look at, and odd rows."""

import random
import zlib

import numpy as np
import pytest

from docweir.llm import lexicon, quality, toxicity
from docweir.llm.lexicon import LexiconAutomaton, Term

SF = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = [Term("idiot", max_edits=1), Term("scum"), Term("worthless", max_edits=2), Term("trash", max_edits=1), Term("abcabc", max_edits=1)]
    automaton = LexiconAutomaton(terms)
    rnd = random.Random(3)
    words = [t.text for t in terms]
    for _ in range(4000):
        w = list(rnd.choice(words))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(w) + 1)
            w[at : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "s", "z", "é"])
        word = "".join(w)
        close = [(distance(word, t.text), k) for k, t in enumerate(terms) if distance(word, t.text) <= t.max_edits]
        got = automaton.match(word)
        assert (got is None) == (not close), word
        if close:
            assert got[1] == min(close)[0]
    assert LexiconAutomaton([]).match("word") is None


def test_stems():
    automaton = LexiconAutomaton([Term("achlich", True), Term("achtung")])
    assert automaton.match("achlichkeit") == (0, 0) and automaton.match("achlich") == (0, 0)
    assert automaton.match("achlic") is None and automaton.match("achtung") == (1, 0) and automaton.match("achtungen") is None


def test_context_and_spelling():
    reader = toxicity.TextReader([Term("idiot", max_edits=1), Term("worthless", max_edits=2)], frozenset({"idioms"}))
    plain = reader.features("you are an idiot and worthless " + "word " * 50)
    assert reader.features("you are an id1ot and wortless " + "word " * 50)[0] > 0
    assert reader.features("idioms " * 20) == [0.0] * toxicity.N_FEATURES
    quoted = reader.features('she wrote "you are an idiot and worthless" ' + "word " * 50)
    french = reader.features("il dit « idiot worthless » " + "word " * 50)
    assert quoted[0] < plain[0] and quoted[4] == 1.0 and plain[4] == 0.0 and french[4] == 1.0
    assert reader.features(None) == reader.features("") == [0.0] * toxicity.N_FEATURES
    dense = reader.features("idiot idiot idiot " + "word " * 200)
    spread = reader.features(("idiot " + "word " * 66) * 3)
    assert dense[3] > spread[3]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("name, module, column, least", [("op9", quality, "quality", 0.97), ("op5", toxicity, "toxic", 0.97)])
def test_held_out_accuracy(spark, name, module, column, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in module.score_documents(docs, labels).collect()}
    assert len(got) == docs.count() and all(r.held_out == held_out(i) and 0 <= r.score <= 1 for i, r in got.items())
    threshold = 0.7 if column == "quality" else 0.3
    assert all(r.predicted == (r.score >= threshold) for r in got.values())
    known = [(got[r.doc_id].predicted, r[column]) for r in labels.collect() if held_out(r.doc_id)]
    assert np.mean([a == b for a, b in known]) >= least
    found = sum(a and b for a, b in known)
    assert found >= 0.9 * sum(b for _, b in known) and found >= 0.95 * sum(a for a, _ in known)


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_labels_change_nothing(spark, module, column):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    kept = labels.where(f"crc32(CAST(CAST(doc_id AS string) AS binary)) % 4 != 2")
    first, second = (sorted((r.doc_id, round(r.score, 6)) for r in module.score_documents(docs, x).collect()) for x in (labels, kept))
    assert first == second


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, module, column):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (2, ""), (None, "text"), (3, " \n\t"), (4, "word " * 30_000), (5, "!!! ### |||"), (6, "日本語")], "doc_id long, text string"
    ).selectExpr("*", "'x' AS y", "1 AS score", "2 AS part")
    for rows in ([], [(1, 1), (3, 1)], [(1, 0), (4, 1), (4, 0), (None, 1), (5, None), (6, 1), (9, 0)]):
        labels = spark.createDataFrame(rows, f"doc_id long, {column} int")
        got = module.score_documents(docs, labels).collect()
        assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    empty = spark.createDataFrame([], f"doc_id long, {column} int")
    assert {r.score for r in module.score_documents(docs, empty).collect()} == {0.5}
    assert module.score_documents(docs.limit(0), empty).count() == 0


def test_pooled_levels_never_fall():
    levels = quality._isotonic(np.array([0.0, 3, 1, 4, 2]), np.array([2.0, 4, 4, 4, 4]))
    assert list(levels) == [0, 0.5, 0.5, 0.75, 0.75]


def test_misspelled_stems_equal_edit_distance():
    terms = [Term("achlich", True, 1), Term("bomenteca", True, 2), Term("trash", max_edits=1)]
    automaton = LexiconAutomaton(terms)
    rnd = random.Random(4)
    for _ in range(3000):
        w = list(rnd.choice(("achlichkeit", "bomentecado", "trash", "bomenteca")))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(w) + 1)
            w[at : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "s", "z", "é"])
        word = "".join(w)
        least = [min(distance(word[:n], t.text) for n in range(0 if t.stem else len(word), len(word) + 1)) for t in terms]
        close = [d for d, t in zip(least, terms, strict=True) if d <= t.max_edits]
        got = automaton.match(word)
        assert (got is None) == (not close) and (not close or got[1] == min(close)), word


def labelled(spark, toxic, harmless):
    rows = [(4 * k + 1, t, int(k < len(toxic))) for k, t in enumerate([*toxic, *harmless])]
    rows = [(i, t, y) for i, t, y in rows if not held_out(i)]
    return spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_learned_terms_meet_misspellings(spark):
    rnd = random.Random(8)
    filler = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu") for b in ("ver", "tan", "sil") for c in ("do", "ra", "pex")]

    def text(*more):
        return " ".join(rnd.sample([*rnd.choices(filler, k=60), *more], 60 + len(more)))

    endings = ("an", "ett", "ilo", "omm", "urr", "ysk", "arp", "epp")
    toxic = [text("grabbelz" + e, "wretchedly") for e in endings * 25]
    # A tenth of the harmless documents hold one and the same neighbour of a term.
    harmless = [text("wretchetly") if k % 10 == 0 else text() for k in range(1500)]
    model = toxicity.fit_toxicity(*labelled(spark, toxic, harmless))
    match = model.reader().matches
    assert any(t.stem and t.max_edits for t in model.terms)
    assert match["grabbelzolf"] and match["grabelzolf"] and match["wretchadly"] and not match["wretchetly"]


def test_quotes_in_long_lines():
    reader = toxicity.TextReader([Term("idiot", max_edits=1)], frozenset())
    far = "thing " * 200
    cases = {f'"{far}idiot {far}"': 1.0, f'"{far}" idiot {far}"': 0.0, f"«{far}idiot {far}»": 1.0, f"„{far}“ idiot": 0.0, f"„{far}idiot {far}“": 1.0}
    cases |= {f'"{far}\nidiot {far}"': 0.0, f'"{far}idiot {far}\n"': 0.0, f'"{far}idiot" {far} idiot': 0.5}
    for text, share in cases.items():
        assert reader.features(text)[4] == share, text[:20]


def test_rare_terms_enter_the_lexicon():
    # 12 of 2,000 toxic documents hold a term, and none of 14,000 others.
    positive = {(f"common{k}", False): 30 for k in range(5_000)} | {("rareslur", False): 12}
    terms = toxicity._lexicon(positive, {k: 210 for k in positive if k != ("rareslur", False)}, 2_000, 14_000)
    assert [t.text for t in terms] == ["rareslur"]
    assert toxicity._lexicon({("rareslur", False): 12}, {("rareslur", False): 60}, 2_000, 14_000) == []
    assert toxicity._by_chance(3, 1, 0.25) == pytest.approx(4 * 0.25**3 * 0.75 + 0.25**4)


def test_quotes_and_abuse():
    """Each pair of sentences has the same terms, quoted in the first and meant in the second."""
    reader = toxicity.TextReader([Term("idiot", max_edits=1), Term("worthless", max_edits=2)], frozenset())
    pairs = [
        ('The report quotes him: "you worthless idiot" was the phrase.', "Listen, you worthless idiot, that was the phrase."),
        ("She said 'idiot' and left.", "She said you  idiot and left."),
        ("The word: \t'idiot' is a slur.", "The word is out, you \t idiot."),
        ("Er schrieb „idiot“ in das Heft.", "Er schrieb wie ein idiot in das Heft."),
        ("Elle a écrit « worthless idiot » hier.", "Elle a écrit comme un worthless idiot hier."),
        ("he called him 'idi0t' again", "he called you an  idi0t again"),
    ]
    for quoted, meant in pairs:
        a, b = reader.features(quoted), reader.features(meant)
        assert a[4] == 1.0 and b[4] == 0.0 and 0 < a[0] < b[0] and a[1] < b[1], quoted


def test_long_words_are_terms():
    word = "schimpf" * 6
    assert (word, False) in toxicity._terms_in(f"ein {word} hier")
    positive = {(word, False): 40} | {(f"term{k:05}x", False): 40 for k in range(1_500)}
    assert len(toxicity._lexicon(positive, {}, 2_000, 14_000)) == 1_501


def test_matches_equal_a_scan_with_edit_distance():
    terms = [Term("idiot", max_edits=1), Term("worthless", max_edits=2), Term("scum")]
    reader = toxicity.TextReader(terms, frozenset({"idioms"}))
    rnd = random.Random(6)
    words = []
    for _ in range(800):
        w = list(rnd.choice(("idiot", "worthless", "scum", "idioms", "plain", "words")))
        for _ in range(rnd.randint(0, 3)):
            w[(at := rnd.randrange(len(w) + 1)) : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "e"])
        words.append("".join(w))
    text = " ".join(words)
    expected = []
    for w in toxicity.words_of(text):
        close = [(distance(w, t.text), k) for k, t in enumerate(terms) if distance(w, t.text) <= t.max_edits]
        if close and not (min(close)[0] and w == "idioms"):
            expected.append((w, min(close)[0]))
    assert [(w, e) for w, _, e in reader.hits(text)] == expected and len(expected) > 100


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, quality.N_STATISTICS))
    z = quality._fourier(x, np.zeros(quality.N_STATISTICS), np.ones(quality.N_STATISTICS))[:, :-1]
    squared = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-squared / (2 * quality.N_STATISTICS))).max() < 0.3
    assert np.abs(z @ z.T - np.exp(-squared / (2 * quality.N_STATISTICS))).mean() < 0.07


def test_isotonic_levels_equal_the_minmax_formula():
    rng = np.random.default_rng(2)
    for _ in range(40):
        n = int(rng.integers(1, 15))
        counts, means = rng.uniform(0.5, 4, n), rng.uniform(0, 1, n)
        got = quality._isotonic(means * counts, counts)

        def mean(i, j):
            return (means[i : j + 1] * counts[i : j + 1]).sum() / counts[i : j + 1].sum()

        expected = [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
        assert np.allclose(got, expected)


def test_copies_of_a_text_are_no_evidence(spark):
    rnd = random.Random(9)
    filler = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu") for b in ("ver", "tan", "sil") for c in ("do", "ra", "pex")]

    def text(*more):
        return " ".join(rnd.sample([*rnd.choices(filler, k=40), *more], 40 + len(more)))

    # Each toxic text has a word of its own, and many copies that differ in white space.
    toxic = [text("wretchedly", f"{a}{b}ownword") for a in "bcdfgh" for b in "jklmnp"]
    harmless = [text() for _ in range(300)]
    copies = [[t.replace(" ", " " * (1 + k % 2)) for k in range(12) for t in texts] for texts in (toxic, harmless)]
    docs, labels = labelled(spark, *copies)
    model = toxicity.fit_toxicity(docs, labels)
    once = docs.selectExpr("doc_id", "replace(text, '  ', ' ') AS text").dropDuplicates(["text"])
    single = toxicity.fit_toxicity(once, labels)
    assert [t.text for t in model.terms] == ["wretchedly"] and model.terms == single.terms and model.ordinary == single.ordinary
    assert np.allclose(model.weights, single.weights)


def test_states_of_the_automaton_are_bounded(monkeypatch):
    terms = [Term("idiot", max_edits=1), Term("worthless", max_edits=2), Term("achlich", True, 1)]
    whole, words, rnd = LexiconAutomaton(terms), [], random.Random(10)
    for _ in range(3000):
        w = list(rnd.choice(("idiot", "worthless", "achlichkeit")))
        for _ in range(rnd.randint(0, 3)):
            w[(at := rnd.randrange(len(w) + 1)) : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "e", "t", "é"])
        words.append("".join(w))
    expected, size = [whole.match(w) for w in words], whole.size
    monkeypatch.setattr(lexicon, "STATE_BOUND", size // 8)
    kept, sizes = LexiconAutomaton(terms), []
    for word, found in zip(words, expected, strict=True):
        assert kept.match(word) == found, word
        sizes.append(kept.size)
    assert max(sizes) < size // 4 and sizes != sorted(sizes)
