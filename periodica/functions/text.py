"""Text functions as Column expressions. Digits are ASCII; white space is Unicode's.

T8 to T11, T20, T21 and the text of T33 take what `normalize` gives, or a part of it: a page
is normalised once, not by each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

SPACE = r"(?U)\s+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE, " "))


def normalize(text: Column | str) -> Column:
    """T1 without HTML unescaping (helpers.values.unescape does that): fixed characters, one space, trim."""
    text = F.coalesce(col(text), F.lit(""))
    return squeeze(F.translate(text, "".join(fixed.CHARACTERS), "".join(fixed.CHARACTERS.values())))


def canonical_pick(pick: Column | str) -> Column:
    """Top or bottom; null for any other word."""
    words = F.create_map(*[F.lit(x) for kv in fixed.PICK_ALIASES.items() for x in kv])
    return F.try_element_at(words, F.lower(normalize(pick)))


def words(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def contains_any(text: Column, keywords: Column) -> Column:
    """A keyword occurs, with or without regard to spaces."""
    bare = F.replace(text, F.lit(" "), F.lit(""))
    return F.exists(keywords, lambda k: F.contains(text, k) | F.contains(bare, F.replace(k, F.lit(" "), F.lit(""))))


def contains_none(text: Column, keywords: Column) -> Column:
    """T4."""
    return ~F.exists(keywords, lambda k: F.contains(text, k))


def strip_tags(text: Column) -> Column:
    """T5."""
    return normalize(F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", " "))


def first_issue(text: Column) -> Column:
    """The first issue number; null without one."""
    return F.regexp_extract(text, fixed.ISSUE, 1).try_cast("int")


def leading_issue(text: Column) -> Column:
    return F.regexp_extract(text, "^" + fixed.ISSUE, 1).try_cast("int")


def all_issues(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(fixed.ISSUE), F.lit(1)), lambda d: d.cast("int"))


def last_issue(text: Column) -> Column:
    return F.try_element_at(all_issues(text), F.lit(-1))


def issue_chunks(text: Column) -> Column:
    """The text cut before each issue number; trimmed, without empty pieces."""
    pieces = F.transform(F.split(text, fixed.ISSUE_START, -1), lambda p: F.trim(p))
    return F.filter(pieces, lambda p: p != "")


def bounded_window(chunk: Column, span: Column | int) -> Column:
    """At most max(80, span) characters, never cut inside a number or an open bracket."""
    limit = F.greatest(F.lit(80), F.lit(span) if isinstance(span, int) else span)
    text = F.substring(chunk, F.lit(1), limit)
    count = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    open_bracket = (count("[") > count("]")) | (count("(") > count(")"))
    back = F.regexp_replace(text, r" [^ ]*$", "")
    cut = F.when(F.length(back) < F.length(text), F.when(F.length(back) > 0, back)).otherwise(F.lit(None))
    dropped = F.regexp_replace(text, r"[\d\[\]()]+\s*$", "")
    return F.when(F.length(chunk) <= limit, chunk).when(text.rlike(r"\d$") | open_bracket, F.coalesce(cut, dropped)).otherwise(text)


def has_draw(text: Column) -> Column:
    """A real draw field, once addresses and noise words are taken out."""
    plain = F.regexp_replace(text, fixed.DRAW_URL, "　")
    return F.regexp_replace(plain, "|".join(fixed.DRAW_NOISE_WORDS), "　").rlike(fixed.DRAW_FIELD)


def prediction_part(text: Column) -> Column:
    """What stands before the first true draw marker."""
    at = F.regexp_instr(text, F.lit(fixed.DRAW_BOUNDARY))
    return F.trim(F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text))


def draw_text(text: Column) -> Column:
    """The first draw token with its mark; empty without one."""
    token = F.regexp_extract(text, fixed.DRAW_TEXT, 1)
    return F.when(token == "", F.lit("")).otherwise(F.concat(F.lit("开"), F.regexp_replace(token, "^[:?]+|[:?]+$", "")))


def cell_digit(text: Column) -> Column:
    """A whole cell that holds one digit or one Chinese numeral; else null."""
    plain = normalize(text)
    ascii_digit = F.regexp_extract(plain, r"^[\[(]?\s*(\d)\s*尾?\s*[\])]?$", 1)
    numeral = F.regexp_extract(plain, r"^[\[(]?\s*([零〇一二三四五六七八九])\s*尾\s*[\])]?$", 1)
    as_digit = F.translate(F.replace(numeral, F.lit("〇"), F.lit("零")), fixed.CHINESE_DIGITS, "0123456789")
    return F.coalesce(F.when(ascii_digit != "", ascii_digit), F.when(numeral != "", as_digit)).cast("int")


def exact_digit(raw: Column) -> Column:
    """One digit, or one repeated; null for a mixed number."""
    return F.when(raw.rlike(r"^(\d)\1*$"), F.substring(raw, 1, 1).cast("int"))


def wave_value(text: Column) -> Column:
    """Colour and parity where half-waves are spoken of; else empty."""
    part = prediction_part(text)
    return F.when(F.contains(part, F.lit("半波")), F.regexp_extract(part, fixed.WAVE, 1)).otherwise("")


def snippet(text: Column, limit: int = 160) -> Column:
    """T21."""
    plain = F.trim(text)
    return F.when(F.length(plain) <= limit, plain).otherwise(F.concat(F.rtrim(F.substring(plain, 1, limit)), F.lit("...")))


def ranking_parts(value: Column) -> Column:
    """One or two digits of a result value; empty for any other text."""
    bare = F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\s+", "")
    fits = bare.rlike(r"^(\d|\d、\d|(\d尾){1,2}|\d、\d尾)$")
    return F.when(fits, F.regexp_extract_all(bare, F.lit(r"(\d)"), F.lit(1))).otherwise(F.array().cast("array<string>"))


def valid_value(value: Column, paired: Column) -> Column:
    """Two digits where the publisher is pair-valued, else one."""
    return F.coalesce(F.when(paired, value.rlike(r"^\d、\d$")).otherwise(value.rlike(r"^\d$")), F.lit(False))


def result_line(value: Column, name: Column) -> Column:
    """The report line of a success."""
    digits = ranking_parts(value)
    label = F.array_join(F.transform(digits, lambda d: F.concat(d, F.lit("尾"))), " ")
    return F.concat_ws(" ", F.when(F.size(digits) > 0, label).otherwise(value), name)


def failure_class(text: Column) -> Column:
    """T25, in this order of precedence."""
    low = F.lower(text)
    named = [F.when(low.rlike(words), fixed.FAILURE_CLASSES[kind]) for kind, words in fixed.FAILURE_WORDS.items()]
    return F.coalesce(*named, F.lit(fixed.FAILURE_CLASSES["other"]))


def retryable(message: Column) -> Column:
    """A transport failure that isn't about certificates or redirects."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return ~low.rlike(fixed.FINAL_WORDS) & low.rlike(fixed.TRANSPORT_WORDS)


def parse_issues(text: Column) -> Column:
    """Positive whole numbers separated by spaces or commas, first occurrences in order;
    null if any piece is no such number or there is none."""
    parts = F.filter(F.split(F.trim(text), r"[\s,，]+", -1), lambda p: p != "")
    numbers = F.transform(parts, lambda p: F.when(p.rlike(r"^\d+$"), p.try_cast("int")))
    good = (F.size(parts) > 0) & F.forall(numbers, lambda n: n.isNotNull() & (n > 0))
    return F.when(good, F.array_distinct(numbers))


def base64_blocks(text: Column) -> Column:
    """Decoded payloads of the three wrappers, in their order; what isn't valid is skipped."""
    found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(2)) for p in (fixed.STRDECODE, fixed.DECODE_B64, fixed.PAGE_DATA)])
    bare = F.transform(found, lambda b: F.regexp_replace(b, r"\s+", ""))
    padded = F.transform(bare, lambda b: F.concat(b, F.repeat(F.lit("="), F.pmod(-F.length(b), F.lit(4)).cast("int"))))
    strict = F.filter(padded, lambda b: b.rlike(r"^[A-Za-z0-9+/]*={0,2}$"))
    decoded = F.transform(strict, lambda b: F.try_validate_utf8(F.try_to_binary(b, F.lit("base64")).cast("string")))
    return F.filter(decoded, lambda d: d.isNotNull())


def sub_documents(blocks: Column) -> Column:
    """The non-empty blocks and, after them, all joined by line feeds."""
    full = F.filter(blocks, lambda b: F.trim(b) != "")
    return F.when(F.size(full) > 0, F.concat(full, F.array(F.array_join(full, "\n")))).otherwise(full)


def written_html(text: Column) -> Column:
    """The string literals of document.writeln, joined, their escapes undone: quotes and backslashes
    first, then carriage returns, line feeds and tabs."""
    literals = F.regexp_extract_all(text, F.lit(fixed.WRITELN), F.lit(2))

    def undone(literal: Column) -> Column:
        plain = F.regexp_replace(literal, r"""\\(['"\\])""", "$1")
        for mark, character in (("\\r", "\r"), ("\\n", "\n"), ("\\t", "\t")):
            plain = F.replace(plain, F.lit(mark), F.lit(character))
        return plain

    return F.array_join(F.transform(literals, undone), "\n")


def names_site(text: Column, name: Column) -> Column:
    """The publisher's name occurs; a blank one always does."""
    plain = normalize(name)
    return (plain == "") | F.contains(text, plain)


def signal_words(keywords: Column, name: Column) -> Column:
    """Keywords but for the publisher's own name."""
    return F.filter(keywords, lambda k: k != normalize(name))
