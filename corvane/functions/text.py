"""Text expressions. All take and return columns and stay inside Spark's code generation or its built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define calls, function references, store references, labels and file names.
LITERAL_OR_COMMENT = r'"(?:[^"]++|"")*+(?:"|$)|;.*'
CALL = r"\b(D|DO|G|GOTO|J|JOB)\b(?::\S+)? +([A-Z%][A-Z0-9]*)?\^(%?[A-Z][A-Z0-9]*)"
FUNCTION = r"\$\$([A-Z%][A-Z0-9]*)?\^(%?[A-Z][A-Z0-9]*)"
STORE = r"(?<![A-Z0-9$])\^(%?[A-Z][A-Z0-9]*)\("
CALL_LIST = r"\b(D|DO|G|GOTO|J|JOB)\b(?::\S+)? +((?:[A-Z%][A-Z0-9]*)?\^%?[A-Z][A-Z0-9]*(?:,(?:[A-Z%][A-Z0-9]*)?\^%?[A-Z][A-Z0-9]*)*)"
DATA_FILE = r"^(\d+(?:\.\d+)?)(?:-(\d+))?\+(.+)\.zwr$"
STORE_FILE = r"^([^+]+)\.zwr$"
ANY_LINE_BREAK = r"\r\n?|[\n\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
KINDS = {"D": "do", "G": "goto", "J": "job"}


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def lines_of(text: Column, pattern: str = "\n") -> Column:
    """Lines of a text; a final line break adds none, an empty or null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), pattern, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def without_literals(line: Column) -> Column:
    """The line without quoted literals (a doubled quote escapes, an open literal runs to the end) and comment."""
    return F.when(line.contains('"') | line.contains(";"), F.regexp_replace(line, LITERAL_OR_COMMENT, "")).otherwise(line)


def call_texts(clean: Column, every_argument: bool = False) -> Column:
    """Each verb's first argument, or with ``every_argument`` all in its comma list, as a text: the verb first, and behind the last space ``TAG^UNIT``."""
    if not every_argument:
        return F.regexp_extract_all(clean, F.lit(CALL), F.lit(0))
    lists = F.regexp_extract_all(clean, F.lit(CALL_LIST), F.lit(0))
    return F.flatten(F.transform(lists, lambda m: F.transform(F.split(F.substring_index(m, " ", -1), ","), lambda r: F.concat(F.substring(m, 1, 1), F.lit(" "), r))))


def function_texts(clean: Column) -> Column:
    return F.regexp_extract_all(clean, F.lit(FUNCTION), F.lit(0))


def reference_parts(m: Column) -> Column:
    """(tag, unit, kind) of a text that call_texts() or function_texts() gives.

    No pattern is tried a second time: what stands behind the last space or the
    dollars is the reference, and a verb is known by its first letter.
    """
    function = m.startswith("$$")
    ref = F.when(function, F.substring(m, 3, 1 << 30)).otherwise(F.substring_index(m, " ", -1))
    kind = F.when(function, F.lit("func"))
    for letter, name in KINDS.items():
        kind = kind.when(m.startswith(letter), F.lit(name))
    return F.struct(F.substring_index(ref, "^", 1).alias("tag"), F.substring_index(ref, "^", -1).alias("unit"), kind.alias("kind"))


def call_references(clean: Column, every_argument: bool = False) -> Column:
    """(tag, unit, kind) of each verb's first argument, or with ``every_argument`` of all in its comma list."""
    return F.transform(call_texts(clean, every_argument), reference_parts)


def all_references(clean: Column, every_argument: bool = False) -> Column:
    return F.transform(F.concat(call_texts(clean, every_argument), function_texts(clean)), reference_parts)


def store_references(clean: Column) -> Column:
    return F.regexp_extract_all(clean, F.lit(STORE), F.lit(1))


def line_class(line: Column) -> Column:
    """label (a letter, digit or % in the first place), comment (a semicolon after blanks) or other."""
    return F.when(line.rlike(r"^[A-Za-z0-9%]"), "label").when(line.rlike(r"^[ \t]*;"), "comment").otherwise("other")


def is_label_line(line: Column) -> Column:
    """Lines that begin with neither a blank nor a semicolon; an empty line doesn't count."""
    return (line != "") & ~line.rlike(r"^[ \t;]")


def shortened(c: Column, n: int = 120) -> Column:
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n - 3), F.lit("..."))).otherwise(c)


def first_line(lines: Column) -> Column:
    return F.coalesce(F.get(lines, F.lit(0)), F.lit(""))


def version_line(lines: Column) -> Column:
    """The second line where it starts with two semicolons after blanks, else empty."""
    second = F.regexp_replace(F.coalesce(F.get(lines, F.lit(1)), F.lit("")), r"^[ \t]+", "")
    return F.when(second.startswith(";;"), second).otherwise("")


def patches(version: Column) -> Column:
    """Patch numbers between double asterisks, without blanks."""
    return F.filter(F.split(F.regexp_extract(version, r"\*\*([^*]*)\*\*", 1), ","), lambda p: F.trim(p) != "")


def header_field(version: Column, k: int) -> Column:
    """The k-th (from 1) semicolon field after the leading pair of them."""
    return F.coalesce(F.get(F.split(F.regexp_replace(version, r"^[ \t]*;;", ""), ";"), F.lit(k - 1)), F.lit(""))


def reference_tag(ref: Column) -> Column:
    return F.when(ref.contains("^"), F.substring_index(ref, "^", 1)).otherwise("")


def reference_unit(ref: Column) -> Column:
    return F.when(ref.contains("^"), F.split_part(ref, F.lit("^"), F.lit(2))).otherwise(ref)


def spaced_reference(ref: Column) -> Column:
    """(unit, tag) of ``UNIT TAG``."""
    parts = F.split(ref, " ", 2)
    return F.struct(F.get(parts, F.lit(0)).alias("unit"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("tag"))


def file_class(name: Column) -> Column:
    """(kind, number, chunk, entity) of a data file's name; other shapes are an error."""
    return (
        F.when(
            name.rlike(DATA_FILE),
            F.struct(
                F.lit("file").alias("kind"), F.regexp_extract(name, DATA_FILE, 1).alias("number"), F.regexp_extract(name, DATA_FILE, 2).alias("chunk"), F.regexp_extract(name, DATA_FILE, 3).alias("entity")
            ),
        )
        .when(
            name.rlike(STORE_FILE),
            F.struct(F.lit("global").alias("kind"), F.lit("").alias("number"), F.lit("").alias("chunk"), F.regexp_extract(name, STORE_FILE, 1).alias("entity")),
        )
        .otherwise(F.raise_error(F.concat(F.lit("unknown file name: "), F.coalesce(name, F.lit("null")))).cast("struct<kind: string, number: string, chunk: string, entity: string>"))
    )


def moved_path(path: Column, old: str, new: str) -> Column:
    """The path with its prefix exchanged; another prefix is an error."""
    return F.when(path.startswith(old), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1 << 30))).otherwise(
        F.raise_error(F.concat(F.lit("not below the expected folder: "), F.coalesce(path, F.lit("null")))).cast("string")
    )


def pointer_target(spec: Column, decimals: bool = False) -> Column:
    """The number of the record type that a field's type specification points to, as text; blank if none.

    By default digits end at a point, and letters P between digits are skipped;
    ``decimals`` reads whole decimal numbers.
    """
    if decimals:
        return F.regexp_extract(spec, r"[Pp]([0-9]+(?:\.[0-9]+)?)", 1)
    return F.regexp_replace(F.regexp_extract(spec, r"[Pp]([0-9][0-9Pp]*)", 1), "[Pp]", "")


def data_type(spec: Column) -> Column:
    """The field's type by the first of the letters, in this order, that the specification holds."""
    # fixed values, in the order in which the letters are tried
    names = {
        "P": "POINTER", "V": "VARIABLE-POINTER", "C": "COMPUTED", "D": "DATE", "S": "SET", "N": "NUMERIC", "W": "WORD-PROCESSING",
        "M": "MUMPS", "F": "FREE-TEXT",
    }
    out = None
    for letter, name in names.items():
        out = F.when(spec.contains(letter), name) if out is None else out.when(spec.contains(letter), name)
    return out.otherwise("OTHER")


def store_name(root: Column) -> Column:
    return F.regexp_extract(root, r"\^([^(^]*)", 1)


def severity(text: Column) -> Column:
    first = F.substring(F.trim(text), 1, 1)
    return F.when(first.isin("F", "W", "I", "S", "E"), first).otherwise("?")


def action_text(c: Column) -> Column:
    """Tabs become spaces; carriage returns and line feeds go."""
    return F.translate(c, "\t\n\r", " ")


def normalised(text: Column) -> Column:
    """One kind of line break, leading tabs as spaces, no trailing blanks, one final line break; idempotent."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    t = F.regexp_replace(t, r"(?m)^\t+", " ")
    t = F.regexp_replace(t, r"(?m)[ \t]+$", "")
    return F.concat(F.regexp_replace(t, r"\n+\z", ""), F.lit("\n"))


def tags_of_line(line: Column) -> Column:
    return F.regexp_extract(line, r"^([A-Za-z%][A-Za-z0-9]*)", 1)


def line_head(line: Column) -> Column:
    """What stands before the first parenthesis, space or tab; blank for lines that begin with a blank or a semicolon."""
    return F.when(line.rlike(r"^[ \t;]"), F.lit("")).otherwise(F.regexp_extract(line, r"^([^( \t]*)", 1))


def structural_label(line: Column) -> Column:
    """Whether a label line is one that needs no documentation."""
    return tags_of_line(line).isin("STARTUP", "SHUTDOWN")  # fixed values


def whole_test_name(unit: Column) -> Column:
    """The name of a unit's test before it is cut."""
    return F.concat(F.lit("T"), unit)


def cut_name(name: Column) -> Column:
    """The 8 characters that a unit's name may have."""
    return F.substring(name, 1, 8)


def test_name(unit: Column) -> Column:
    """The name of a unit's test unit: T before it, cut to 8 characters."""
    return cut_name(whole_test_name(unit))


def entry_point(tag: Column, unit: Column) -> Column:
    """``TAG^UNIT``, or the unit alone without a tag."""
    return F.when(F.coalesce(tag, F.lit("")) != "", F.concat(tag, F.lit("^"), F.coalesce(unit, F.lit("")))).otherwise(F.coalesce(unit, F.lit("")))
