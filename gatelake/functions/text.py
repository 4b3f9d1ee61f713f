"""Column functions over source text. All are JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatelake.functions import patterns as P


def normalize_newlines(text: Column) -> Column:
    """CRLF and lone CR become LF, as text-mode reads do."""
    return F.regexp_replace(text, "\r\n?", "\n")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    A column used inside a higher-order function is evaluated again for every
    element; binding it as a lambda variable avoids that.
    """
    return F.get(F.transform(F.array(value), body), 0)


def interleave(gaps: Column, tokens: Column, rewrite) -> Column:
    """Rebuild ``gap0 tok0 gap1 tok1 …`` with ``rewrite(token)`` in place of each token.

    Linear in the text length: the gaps come from one ``split`` and the tokens
    from one ``regexp_extract_all`` with the same pattern; the last gap has no token.
    """
    return F.array_join(
        F.zip_with(gaps, tokens, lambda g, t: F.concat(g, F.when(t.isNull(), F.lit("")).otherwise(rewrite(t)))), "")


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def line_count(text: Column) -> Column:
    """Lines as a reader sees them: an unterminated last line counts, empty text has none."""
    newlines = F.length(text) - F.length(F.translate(text, "\n", ""))
    open_tail = F.when((text == "") | F.endswith(text, F.lit("\n")), 0).otherwise(1)
    return (newlines + open_tail).cast("long")


def count_matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern that cannot match empty text: the pieces between them, less one.

    Splitting copies only what lies between matches, counting by extraction copies every match.
    """
    return (F.size(F.split(text, pattern)) - 1).cast("long")


def non_blank_lines(text: Column) -> Column:
    """Lines that hold at least one non-whitespace character: one match runs from it to the line end."""
    return count_matches(text, rf"{P.NON_WHITESPACE}[^\n]*")


def strip_whitespace(text: Column) -> Column:
    """Text without whitespace. ASCII text (bytes = characters) takes the two-range class."""
    return F.when(
        F.octet_length(text) == F.length(text), F.regexp_replace(text, P.ASCII_WHITESPACE, "")
    ).otherwise(F.regexp_replace(text, P.WHITESPACE, ""))


def non_whitespace_chars(text: Column) -> Column:
    return F.length(strip_whitespace(text)).cast("long")


def byte_size(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def strip_comments(text: Column) -> Column:
    """Comments become one blank; string literals stay as they are.

    A single quote also opens a literal, so comments between ``4'b0`` and a
    later ``2'd1`` stay in place.
    """
    return interleave(
        F.split(text, P.COMMENT_OR_LITERAL),
        find_all(text, P.COMMENT_OR_LITERAL, 0),
        lambda tok: F.when(F.startswith(tok, F.lit("/")), F.lit(" ")).otherwise(tok),
    )


def strip_comments_loose(text: Column) -> Column:
    """One-pass form that may add a blank after a literal; for whitespace-free consumers."""
    return F.regexp_replace(text, P.COMMENT_OR_LITERAL, "$1 ")


def module_name(body: Column) -> Column:
    return F.regexp_extract(body, P.MODULE_NAME, 1)


def count_modules(text: Column, definition_only: bool = False) -> Column:
    """Module definitions in raw text; ``definition_only`` is the pattern without a name."""
    pattern = P.MODULE_DEFINITION_COUNT if definition_only else P.MODULE_COUNT
    return count_matches(text, pattern)


def module_hash(body: Column) -> Column:
    """sha256 of the module text without whitespace; pass comment-free text."""
    return F.sha2(strip_whitespace(body), 256)


def literal_rewrites(text: Column, pairs: list[tuple[str, str]] = P.PRIMITIVE_REWRITES) -> Column:
    """Ordered literal replacements."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Text after the last dot of the file name; the whole name when it has no dot."""
    return F.substring_index(base_name(path), ".", -1)


def file_role(path: Column) -> Column:
    ext = extension(path)
    return (
        F.when(ext.isin(P.VERILOG_EXTENSIONS_ANY), "verilog")
        .when(ext.isin(P.DATA_EXTENSIONS_ANY), "data")
        .otherwise("aux")
    )


def is_testbench(file_name: Column) -> Column:
    return file_name.rlike(r"_tb(\.[^.]*)?$")


def clock_like(name: Column) -> Column:
    """False for names that read as reset, enable, ready or valid."""
    return ~F.lower(name).rlike(P.NON_CLOCK_NAME)


def design_name(prefix: Column, base: Column) -> Column:
    return F.concat_ws("__", prefix, base)


def clean_name(
    base: Column,
    replacements: dict[str, str] | None = None,
    upper: bool = False,
    suffix: str | None = None,
) -> Column:
    """Design-name clean-up: drop a suffix, literal replacements, upper-case."""
    if suffix:
        base = F.when(
            F.endswith(base, F.lit(suffix)),
            F.substring(base, F.lit(1), F.length(base) - len(suffix)),
        ).otherwise(base)
    for old, new in (replacements or {}).items():
        base = F.replace(base, F.lit(old), F.lit(new))
    return F.upper(base) if upper else base


def decode_text(content: Column) -> Column:
    """Text of file bytes: UTF-8 where valid, else Latin-1, which reads any bytes; nothing is lost."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


def decode_status(content: Column) -> Column:
    """``ok``, or ``not_utf8`` for bytes that were read as Latin-1."""
    return F.when(F.is_valid_utf8(content.cast("string")), "ok").otherwise("not_utf8")
