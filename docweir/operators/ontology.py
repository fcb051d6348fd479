"""The controlled vocabulary: loading, keyword mining, merging and writing."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweir.functions.text import strip, text_or_empty

# The vocabulary where no file gives one.
DEFAULT_LABELS = ("Category", "Condition", "Crop", "Disease", "Environment", "Pest", "Practice")
DEFAULT_RELATIONS = ("AFFECTS", "CAUSES", "MENTIONS", "PART_OF", "REQUIRES", "SUSCEPTIBLE_TO", "TREATED_BY")
DEFAULT_MODALITIES = ("text", "table", "image", "formula")
FALLBACK_LABEL = "Condition"
# Words that hint at relations.
HINTS_KO = [
    "원인",
    "관계",
    "연관",
    "비교",
    "왜",
    "이유",
    "어떻게",
    "영향",
    "방지",
    "예방",
    "발생",
    "때문",
    "결과",
    "유발",
    "억제",
    "촉진",
    "증가",
    "감소",
    "악화",
    "개선",
]
HINTS_EN = [
    "why",
    "cause",
    "because",
    "relation",
    "compare",
    "versus",
    "affect",
    "prevent",
    "how",
    "increase",
    "decrease",
    "result",
    "trigger",
    "inhibit",
    "promote",
    "worsen",
    "improve",
]
SCHEMA_VERSION = "ontology_v1"


@dataclass(frozen=True)
class Ontology:
    """What extraction may produce."""

    labels: tuple[str, ...] = DEFAULT_LABELS
    relations: tuple[str, ...] = DEFAULT_RELATIONS
    raw: dict = field(default_factory=dict, compare=False)

    @property
    def labels_csv(self) -> str:
        return ", ".join(sorted(self.labels))

    @property
    def relations_csv(self) -> str:
        return ", ".join(sorted(self.relations))


def read_json(path: str | Path | None) -> dict:
    """The object in a file; empty if it can't be read or holds something else."""
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, TypeError, ValueError):
        return {}
    return found if isinstance(found, dict) else {}


def load_ontology(path: str | Path | None) -> Ontology:
    """The vocabulary of a file; a list that is missing, empty or no list takes its default."""
    raw = read_json(path)

    def listed(key: str, default: tuple[str, ...]) -> tuple[str, ...]:
        given = raw.get(key)
        return tuple(sorted({str(x) for x in given if x})) if isinstance(given, list) and given else default

    return Ontology(listed("allowed_entity_labels", DEFAULT_LABELS), listed("allowed_relation_types", DEFAULT_RELATIONS), raw)


def substring_keywords(text: Column, words: list[str]) -> Column:
    """All occurrences of the words anywhere in a text, in order."""
    return F.regexp_extract_all(text_or_empty(text), F.lit("(" + "|".join(words) + ")"), F.lit(1))


def whole_keywords(text: Column, words: list[str]) -> Column:
    """All occurrences, in lower case, with neither letter, digit nor underscore on either side."""
    pattern = rf"(?iu)(?:^|[^\p{{L}}\p{{N}}_])({'|'.join(words)})(?![\p{{L}}\p{{N}}_])"
    return F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(pattern), F.lit(1))


def mined_keywords(texts: DataFrame, ko: list[str] = HINTS_KO, en: list[str] = HINTS_EN) -> DataFrame:
    """(lang, keyword, n) over all rows of column ``text``; counts are summed before the shuffle."""
    found = F.concat(
        F.transform(substring_keywords(F.col("text"), ko), lambda k: F.struct(F.lit("ko").alias("lang"), k.alias("keyword"))),
        F.transform(whole_keywords(F.col("text"), en), lambda k: F.struct(F.lit("en").alias("lang"), k.alias("keyword"))),
    )
    return texts.select(F.explode_outer(found).alias("k")).where("k IS NOT NULL").groupBy("k.lang", "k.keyword").agg(F.count(F.lit(1)).alias("n"))


def ranked_keywords(texts: DataFrame, seq: str, ko: list[str] = HINTS_KO, en: list[str] = HINTS_EN) -> DataFrame:
    """(lang, keyword, n, rank): by number, then by first occurrence in the order of ``seq``. Only distinct keywords are ranked."""
    first = None
    for lang, found in (("ko", substring_keywords(F.col("text"), ko)), ("en", whole_keywords(F.col("text"), en))):
        one = texts.select(F.lit(lang).alias("lang"), F.col(seq).alias("_seq"), F.posexplode_outer(found).alias("_at", "keyword")).where("keyword IS NOT NULL")
        first = one if first is None else first.union(one)
    counted = first.groupBy("lang", "keyword").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_seq", "_at")).alias("_first"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "_first"))
    return counted.select("lang", "keyword", "n", rank.alias("rank"))


def observed_types(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(kind, name): distinct stripped entity types and upper-case relation types that are not empty."""
    labels = entities.select(F.lit("entity").alias("kind"), strip(text_or_empty(F.col("type"))).alias("name"))
    kinds = relations.select(F.lit("relation").alias("kind"), F.upper(strip(text_or_empty(F.col("type")))).alias("name"))
    return labels.union(kinds).where("name != ''").distinct()


def merged_names(baseline: DataFrame, observed: DataFrame) -> DataFrame:
    """(kind, name) in either; the sorted lists of a vocabulary are per kind."""
    return baseline.select("kind", "name").union(observed.select("kind", "name")).distinct()


def merged_sensors(baseline: Column, overlay: Column) -> Column:
    """Thresholds by sensor; a sensor of the overlay replaces the baseline's as a whole."""
    kept = F.map_filter(baseline, lambda k, _: ~F.array_contains(F.map_keys(overlay), k))
    return F.map_concat(kept, overlay)


def merge_ontology(existing: dict, names: dict[str, set[str]], mined: dict[str, set[str]], n_texts: int, sensors: dict | None = None, domain: str = "general") -> dict:
    """The new vocabulary file: sorted unions with the file on disk, never with the defaults."""
    hints = existing.get("relation_hint_tokens") or {}
    return {
        "schema_version": SCHEMA_VERSION,
        "domain": existing.get("domain", domain),
        "languages": existing.get("languages", ["ko", "en"]),
        "relation_hint_tokens": {lang: sorted({*hints.get(lang, []), *mined.get(lang, ())}) for lang in ("ko", "en")},
        "allowed_entity_labels": sorted({*(existing.get("allowed_entity_labels") or []), *names.get("entity", ())}),
        "allowed_relation_types": sorted({*(existing.get("allowed_relation_types") or []), *names.get("relation", ())}),
        "allowed_modalities": list(existing.get("allowed_modalities") or DEFAULT_MODALITIES),
        "sensor_thresholds": {**(existing.get("sensor_thresholds") or {}), **(sensors or {})},
        "_generation_meta": {
            "observed_entity_count": len(names.get("entity", ())),
            "observed_relation_count": len(names.get("relation", ())),
            "mined_ko_keywords": len(mined.get("ko", ())),
            "mined_en_keywords": len(mined.get("en", ())),
            "chunk_texts_analyzed": n_texts,
        },
    }


def build_ontology(path: str | Path, chunks: DataFrame, entities: DataFrame, relations: DataFrame, sensors: dict | None = None) -> dict:
    """Merge what a run observed into the file at ``path``. Only distinct names reach the driver."""
    names: dict[str, set[str]] = {}
    for row in observed_types(entities, relations).collect():
        names.setdefault(row.kind, set()).add(row.name)
    mined: dict[str, set[str]] = {}
    for row in mined_keywords(chunks).collect():
        mined.setdefault(row.lang, set()).add(row.keyword)
    merged = merge_ontology(read_json(path), names, mined, chunks.count(), sensors)
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(merged, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    return merged
