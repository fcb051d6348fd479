"""Prompts for a language model, its replies, and what of them is valid."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docweir.functions.text import extracted_confidence, extracted_id, once, strip, text_or_empty
from docweir.operators.ontology import Ontology
from docweir.storage import materialize

#: Characters of an image's base64 text that a prompt holds at most.
IMAGE_LIMIT = 1024
ENTITY_TYPE = "struct<text:string,type:string,canonical_id:string,confidence:string>"
RELATION_TYPE = "struct<source:string,target:string,type:string,confidence:string,evidence:string>"
PARSED = f"status string, entities array<{ENTITY_TYPE}>, relations array<{RELATION_TYPE}>"


def prompt(chunks: DataFrame, ontology: Ontology) -> Column:
    """What a model is asked about a chunk: the task, then the text and what is known of its modality."""
    kind = F.lower(strip(F.coalesce(F.nullif(F.col("modality"), F.lit("")), F.lit("text"))))

    def given(column: str) -> Column:
        return F.nullif(F.col(column), F.lit("")) if column in chunks.columns else F.lit(None).cast("string")

    image = given("image_b64_ref")
    shortened = F.when(F.char_length(image) > IMAGE_LIMIT, F.concat(F.substring(image, 1, IMAGE_LIMIT), F.lit("...(truncated)"))).otherwise(image)
    context = strip(
        F.concat_ws(
            "\n\n",
            F.when(kind == "table", F.concat(F.lit("TABLE_HTML:\n"), given("table_html_ref"))),
            F.when(kind == "image", F.concat(F.lit("IMAGE_ASSET_REF: "), given("asset_ref"))),
            F.when(kind == "image", F.concat(F.lit("IMAGE_B64_REF:\n"), shortened)),
            F.when(kind == "formula", F.concat(F.lit("FORMULA_LATEX:\n"), given("formula_latex_ref"))),
            F.concat(F.lit("SOURCE_DOC: "), given("source_doc")),
        )
    )
    focus = F.when(kind == "table", "table").when(kind == "image", "image caption/meta").when(kind == "formula", "formula/latex").otherwise("text")
    # The instructions, which models' replies depend on.
    task = (
        "You are an agriculture knowledge extractor. Return ONLY JSON with keys: entities, relations. "
        f"Allowed entity types: {ontology.labels_csv}. Allowed relation types: {ontology.relations_csv}. "
        "Entity fields: text,type,canonical_id,confidence,scientific_name,aliases,symptom_keywords,growth_stage,metric,unit. "
        "Relation fields: source,target,type,confidence,evidence. Focus on "
    )
    tail = F.when(context == "", "").otherwise(F.concat(F.lit("\n\n"), context))
    return F.concat(F.lit(task), focus, F.lit(" evidence when present.\n\nINPUT:\n"), text_or_empty(F.col("text")), tail)


_FENCED = re.compile(r"```(?:json)?\s*(\{.*\})\s*```", re.IGNORECASE | re.DOTALL)


def recovered_json(reply: str | None):
    """The JSON value of a reply: all of it, else a fenced block, else from the first to the last brace; None if none parses."""
    text = (reply or "").strip()
    fenced = _FENCED.search(text)
    first, last = text.find("{"), text.rfind("}")
    for candidate in (text, fenced and fenced[1], text[first : last + 1] if 0 <= first < last else None):
        try:
            return json.loads(candidate)
        except (TypeError, ValueError):
            continue
    return None


def _as_text(value) -> str:
    """What is falsy is empty, as it is where replies are read field by field."""
    return str(value) if value else ""


def _confidence_text(value) -> str | None:
    """A number that Python reads, in a form that Spark reads; None if it is no number."""
    if not value:
        return "0.0"
    try:
        number = float(value)
    except (TypeError, ValueError):
        return None
    return "NaN" if number != number else repr(min(max(number, -1e300), 1e300))


def parse_reply(reply: str | None) -> dict:
    """Status, entities and relations of a reply.

    ``ok``; ``empty`` if nothing parses, which counts as nothing found; ``bad_shape`` for
    a value that is no object, whose chunk is set aside. Items that are no objects go.
    """
    value = recovered_json(reply)
    if value is None:
        return {"status": "empty", "entities": [], "relations": []}
    if not isinstance(value, dict):
        return {"status": "bad_shape", "entities": [], "relations": []}

    def items(key: str, fields: tuple[str, ...]) -> list[dict]:
        listed = value.get(key) if isinstance(value.get(key), list) else []
        rows = [i for i in listed if isinstance(i, dict)]
        return [{f: _as_text(i.get(f)) for f in fields} | {"confidence": _confidence_text(i.get("confidence"))} for i in rows]

    return {
        "status": "ok",
        "entities": items("entities", ("text", "type", "canonical_id")),
        "relations": items("relations", ("source", "target", "type", "evidence")),
    }


def parsed_replies(replies: DataFrame) -> DataFrame:
    """(chunk_id, status, entities, relations) of (chunk_id, reply). JSON as lenient as Python's needs Python."""

    @F.pandas_udf(StringType())
    def parsed(column):
        return column.map(lambda r: json.dumps(parse_reply(r)))

    return replies.select("chunk_id", F.from_json(parsed("reply"), PARSED).alias("_p")).select("chunk_id", "_p.*")


def exploded(parsed: DataFrame, column: str) -> DataFrame:
    """One row per item of a parsed list, numbered by ``ord``."""
    return parsed.select("chunk_id", F.posexplode(column).alias("ord", "_item")).select("chunk_id", "ord", "_item.*")


def valid_entities(raw: DataFrame, ontology: Ontology) -> DataFrame:
    """(chunk_id, ord, text, type, canonical_id, confidence) of raw entities that hold all it takes.

    The type must be an allowed label, in any case; text and identifier must not be empty.
    A confidence that is no number sets the row aside with ``confidence`` null.
    """
    labels = F.create_map(*[F.lit(x) for label in sorted(ontology.labels) for x in (label.lower(), label)])
    return once(
        raw,
        "chunk_id",
        "ord",
        strip(text_or_empty(F.col("text"))).alias("text"),
        F.try_element_at(labels, F.lower(strip(text_or_empty(F.col("type"))))).alias("type"),
        extracted_id(F.col("canonical_id")).alias("canonical_id"),
        extracted_confidence(F.col("confidence")).alias("confidence"),
    ).where("type IS NOT NULL AND text != '' AND canonical_id != ''")


def valid_relations(raw: DataFrame, ontology: Ontology) -> DataFrame:
    """(chunk_id, ord, source, target, type, confidence, evidence) of raw relations of an allowed type between two identifiers."""
    return once(
        raw,
        "chunk_id",
        "ord",
        extracted_id(F.col("source")).alias("source"),
        extracted_id(F.col("target")).alias("target"),
        F.upper(strip(text_or_empty(F.col("type")))).alias("type"),
        extracted_confidence(F.col("confidence")).alias("confidence"),
        strip(text_or_empty(F.col("evidence"))).alias("evidence"),
    ).where(F.col("type").isin(*ontology.relations) & (F.col("source") != "") & (F.col("target") != ""))


#: Entities of a chunk that are held in one row; a chunk with more is joined item by item.
CROWDED = 10_000


def typed_relations(relations: DataFrame, entities: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Relations with type and text of their endpoints, where the same chunk has an entity of that identifier.

    Identifiers are as ``valid_entities`` and ``valid_relations`` give them. Of a chunk's
    entities with one identifier the last counts, or the greatest by value. A chunk's
    entities come together as one list, and relations meet it once, by their chunk: both
    ends are looked up in it. A chunk of more than ``crowded`` entities, which no reply of
    a model gives, would make too long a list; its relations are joined with entities by
    chunk and identifier, once for either end, so no task holds a whole chunk.
    """
    sizes = entities.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("_n"))
    large = materialize(sizes.where(F.col("_n") > crowded).select("chunk_id"), "crowded-chunks")
    if large.isEmpty():
        return _typed_in_lists(relations, entities)
    parts = [[df.join(large, "chunk_id", kind) for df in (relations, entities)] for kind in ("left_anti", "left_semi")]
    return _typed_in_lists(*parts[0]).unionByName(_typed_by_item(*parts[1]))


def _typed_in_lists(relations: DataFrame, entities: DataFrame) -> DataFrame:
    item = F.struct("ord", "type", "text", "canonical_id")
    lists = entities.groupBy("chunk_id").agg(F.sort_array(F.collect_list(item)).alias("_known"))

    def last(end: str) -> Column:
        same = F.filter("_known", lambda e: e["canonical_id"] == F.col(end))
        return F.get(same, F.size(same) - 1)

    met = relations.join(lists, "chunk_id", "left").withColumns({"_source": last("source"), "_target": last("target")})
    typed = {f"{end}_{c}": F.nullif(F.col(f"_{end}.{c}"), F.lit("")) for end in ("source", "target") for c in ("type", "text")}
    return met.select(*relations.columns, *[c.alias(n) for n, c in typed.items()])


def _typed_by_item(relations: DataFrame, entities: DataFrame) -> DataFrame:
    known = (
        entities.where("canonical_id IS NOT NULL")
        .groupBy("chunk_id", "canonical_id")
        .agg(F.max(F.struct("ord", "type", "text")).alias("_e"))
        .select(F.col("chunk_id").alias("_chunk"), F.col("canonical_id").alias("_key"), F.nullif(F.col("_e.type"), F.lit("")).alias("_type"), F.nullif(F.col("_e.text"), F.lit("")).alias("_text"))
    )
    out = relations
    for end in ("source", "target"):
        same = (F.col("chunk_id") == F.col("_chunk")) & (F.col(end) == F.col("_key"))
        out = out.join(known, same, "left").withColumnsRenamed({"_type": f"{end}_type", "_text": f"{end}_text"}).drop("_chunk", "_key")
    return out
