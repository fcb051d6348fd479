"""Graph tables as statements of a property-graph query language, one to a line, for stores that are loaded from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.functions.text import text_or_empty
from docweir.operators.graph import OPTIONAL


def escaped(value: Column) -> Column:
    """Text for a literal in single quotes: backslashes doubled, quotes behind a backslash; null is empty."""
    return F.replace(F.replace(text_or_empty(value), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))


def literal(value: Column) -> Column:
    """A quoted literal that stays on its line: line ends are written as the escapes that stand for them."""
    on_line = F.replace(F.replace(escaped(value), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.concat(F.lit("'"), on_line, F.lit("'"))


def number(value: Column) -> Column:
    """A share with four decimals."""
    return F.format_number(value, 4)


def _scope() -> list[Column]:
    """The tier, and for private rows whose they are."""
    return [F.concat(F.lit("tier:"), literal(F.col("tier"))), F.concat(F.lit("farm_id:"), literal(F.col("farm_key")))]


def _keyed(*pairs: tuple[str, str]) -> Column:
    """The properties that tell a node or edge apart, in braces."""
    tier, farm = _scope()
    own = [F.concat(F.lit(f"{name}:"), literal(F.col(column))) for name, column in pairs]
    return F.concat(F.lit("{"), F.concat_ws(", ", *own, tier, F.when(F.col("farm_key").isNotNull(), farm)), F.lit("}"))


def _set(of: str, columns: list[str], numbers: tuple[str, ...] = ("confidence",), given_only: tuple[str, ...] = ()) -> Column:
    """What is set on a node or edge; of ``given_only`` columns, and of numbers, only values that are there."""
    parts = []
    for c in columns:
        value = number(F.col(c)) if c in numbers else literal(F.col(c))
        one = F.concat(F.lit(f"{of}.{c}="), value)
        there = F.col(c).isNotNull() if c in numbers else text_or_empty(F.col(c)) != ""
        parts.append(F.when(there, one) if c in given_only or c in numbers else one)
    joined = F.concat_ws(", ", *parts)
    return F.when(joined == "", "").otherwise(F.concat(F.lit(" SET "), joined))


def _node(of: str, label: str | Column, *pairs: tuple[str, str]) -> Column:
    return F.concat(F.lit(f"({of}:"), F.lit(label) if isinstance(label, str) else label, F.lit(" "), _keyed(*pairs), F.lit(")"))


def _entity(of: str, label: str, key: str) -> Column:
    # Labels come from the vocabulary, or are its fallback.
    return _node(of, F.concat(F.lit("Entity:"), F.col(label)), ("canonical_id", key))


def _edge(start: Column, end: Column, kind: str | Column, columns: list[str]) -> Column:
    name = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(F.lit("MATCH "), start, F.lit(", "), end, F.lit(" MERGE (a)-[r:"), name, F.lit(" "), _keyed(), F.lit("]->(b)"), _set("r", columns))


def node_statements(tables: dict[str, DataFrame]) -> DataFrame:
    """(statement) of every chunk, document and entity: merged by its keys, then set. What an entity lacks isn't set, so it erases nothing."""
    entity_columns = ["name", "type", "confidence", "created_at", *OPTIONAL]
    made = {
        "g_chunk": (_node("n", "Chunk", ("chunk_id", "chunk_id")), _set("n", ["text", "source_type", "created_at"])),
        "g_document": (_node("n", "Document", ("doc_id", "doc_id")), _set("n", ["source_doc", "created_at"])),
        "g_entity": (_entity("n", "label", "canonical_id"), _set("n", entity_columns, given_only=("name", "created_at", *OPTIONAL))),
    }
    return _all(tables, {t: F.concat(F.lit("MERGE "), *parts) for t, parts in made.items()})


def edge_statements(tables: dict[str, DataFrame]) -> DataFrame:
    """(statement) of every edge between nodes that are there."""
    document, chunk = _node("a", "Document", ("doc_id", "doc_id")), [_node(of, "Chunk", ("chunk_id", "chunk_id")) for of in "ab"]
    told = ["confidence", "evidence", "created_at"]
    made = {
        "g_has_chunk": _edge(document, chunk[1], "HAS_CHUNK", ["created_at"]),
        "g_mentions": _edge(chunk[0], _entity("b", "label", "canonical_id"), "MENTIONS", told),
        "g_relation": _edge(_entity("a", "src_label", "src"), _entity("b", "tgt_label", "tgt"), F.col("rel_type"), told),
    }
    return _all(tables, made)


def _all(tables: dict[str, DataFrame], made: dict[str, Column]) -> DataFrame:
    found = [tables[t].select(statement.alias("statement")) for t, statement in made.items() if t in tables]
    out = found[0]
    for df in found[1:]:
        out = out.union(df)
    return out


def export_graph(tables: dict[str, DataFrame], path: str) -> None:
    """Write statements as text under ``path``: ``nodes``, to be loaded first, and ``edges``.

    Each task writes a file of its own, which appears when its job is committed, so a task
    that runs again doubles nothing. A path that is there raises.
    """
    for name, statements in (("nodes", node_statements), ("edges", edge_statements)):
        statements(tables).write.text(f"{path}/{name}")
