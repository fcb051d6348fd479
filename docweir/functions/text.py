"""Column functions for text: Unicode white space, tokens, identifiers and hashed slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space: the code points that Unicode calls so, and the four ASCII separators.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: The same as a class of a regular expression.
SPACE = r"(?U)[\s\x1c-\x1f]"
#: ASCII word characters and Hangul syllables.
TOKEN = "[A-Za-z0-9_가-힣]+"
#: Slots of a hashed sparse vector.
N_SLOTS = 65536
MAX_ID_LENGTH = 120
MIN_ID_LENGTH = 3


def once(rows: DataFrame, *columns: Column | str) -> DataFrame:
    """``select`` whose values are computed once for a row, however many filters and columns read them.

    The engine copies expressions into the filters that follow, below shuffles too. It
    copies none through a generator, here one that gives a single row.
    """
    made = rows.select(*columns)
    return made.select(F.inline_outer(F.array(F.struct(*made.columns))))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def strip(value: Column) -> Column:
    """Without Unicode white space at either end; null stays null."""
    return F.btrim(value, F.lit(SPACES))


def blank_to_null(value: Column) -> Column:
    """Stripped, and null if nothing is left."""
    return F.nullif(strip(value.cast("string")), F.lit(""))


def words(value: Column) -> Column:
    """The stretches without white space; null gives none."""
    return F.array_remove(F.split(text_or_empty(value), f"{SPACE}+"), "")


def tokens(value: Column) -> Column:
    """Lower-case index tokens, in order."""
    return F.regexp_extract_all(F.lower(text_or_empty(value)), F.lit(f"({TOKEN})"), F.lit(1))


def slot(token: Column) -> Column:
    """The hashed slot of a token: the first 32 bits of its MD5, modulo the number of slots."""
    return F.conv(F.substring(F.md5(token.cast("binary")), 5, 4), 16, 10).cast("int")


def squeezed_id(value: Column) -> Column:
    """Lower case, white space as underscores, and nothing but a-z, 0-9 and ``_-:.``."""
    plain = strip(F.lower(text_or_empty(value)))
    joined = F.regexp_replace(plain, f"{SPACE}+", "_")
    # Most values are such words between single blanks: matching them whole is far cheaper than looking for what else they hold.
    return F.when(plain.rlike(r"^[a-z0-9_\-:.]++(?: [a-z0-9_\-:.]++)*+\z"), F.replace(plain, F.lit(" "), F.lit("_"))).otherwise(F.regexp_replace(joined, r"[^a-z0-9_\-:.]+", ""))


def extracted_id(value: Column) -> Column:
    """An identifier from a model's reply: empty unless it has 3 to 120 characters."""
    return F.regexp_extract(squeezed_id(value), f"^.{{{MIN_ID_LENGTH},{MAX_ID_LENGTH}}}$", 0)


def graph_id(value: Column) -> Column:
    """An identifier of the graph: cut off after 120 characters."""
    return F.substring(squeezed_id(value), 1, MAX_ID_LENGTH)


def relation_name(value: Column) -> Column:
    """Upper-case letters and underscores; ``MENTIONS`` if none are left."""
    kept = F.regexp_replace(F.upper(strip(text_or_empty(value))), "[^A-Z_]+", "")
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit("MENTIONS"))


def clamped(value: Column) -> Column:
    """Between 0 and 1; NaN counts as 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def extracted_confidence(value: Column) -> Column:
    """A confidence from a reply, as text: missing or blank is 0; what is no number is null."""
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit(0.0)).otherwise(clamped(value.try_cast("double")))


def graph_confidence(value: Column) -> Column:
    """A confidence in the graph, with four decimals: missing or zero is one half."""
    filled = clamped(F.coalesce(F.nullif(value, F.lit(0.0)), F.lit(0.5)))
    # Away from the middle between two numbers of four decimals, rounding needs no text.
    units = filled * 10000
    middle = F.abs(units - F.floor(units) - 0.5) < 1e-6
    return F.when(middle, F.format_number(filled, 4).cast("double")).otherwise(F.rint(units) / 10000)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    """The name without its last suffix; a name that begins with its only dot has none."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def base64_line(content: Column) -> Column:
    """Base64 without line breaks."""
    return F.translate(F.base64(content), "\r\n", "")
