"""String, date and validation expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as blank, word characters, and the form and password rules.
BLANK = r"[\s\x0B\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_BLANKS = "[ \t\n\x0b\f\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"  # the same in Python
SEPARATORS = "\x1c\x1d\x1e\x1f"
WORD_CHARS = r"A-Za-z\x{AC00}-\x{D7A3}0-9"
EMAIL = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"
PASSWORD_RULES = {
    "lowercase": r"[a-z]",
    "uppercase": r"[A-Z]",
    "digit": r"[0-9]",
    "symbol": r"""[!@#$%^&*(),.?":{}|<>_\-+=\\\[\]/~`']""",
}
HANGUL = r"\x{AC00}-\x{D7AF}"
LATIN = "a-zA-Z"
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&copy;": "©", "&middot;": "·", "&amp;": "&"}
BMI_BANDS = ((18.5, "underweight"), (22.9, "normal"), (24.9, "overweight"))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    return F.regexp_replace(_col(c), rf"\A{BLANK}+|{BLANK}+\z", "")


def safe_str(c) -> Column:
    """Trimmed text, empty for null."""
    return F.coalesce(strip(_col(c).cast("string")), F.lit(""))


def split_tags(c, sep: str = ",") -> Column:
    """Separated text to an array of trimmed, non-empty parts; null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(_col(c), F.lit("")), sep, -1), strip)
    return F.filter(parts, lambda x: x != "")


def join_parts(cols: Sequence, sep: str = "\n\n") -> Column:
    return F.concat_ws(sep, *[F.nullif(safe_str(c), F.lit("")) for c in cols])


def first_non_empty(cols: Sequence, default: str = "unknown") -> Column:
    return F.coalesce(*[F.nullif(safe_str(c), F.lit("")) for c in cols], F.lit(default))


def truncate(c, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def eq_ignore_case(a, b) -> Column:
    return F.lower(_col(a)) == F.lower(_col(b))


def tokens(c, min_length: int = 2) -> Column:
    """Lower-case letter and digit runs of at least ``min_length`` characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(f"([{WORD_CHARS}]{{{min_length},}})"), F.lit(1))


def blank_split(c) -> Column:
    """Parts between blanks."""
    return F.filter(F.split(_col(c), f"{BLANK}+", -1), lambda t: t != "")


def blank_words(text: str | None) -> list[str]:
    """``blank_split`` of a text inside a task."""
    text = text or ""
    if any(mark in text for mark in SEPARATORS):  # blanks to str.split alone
        return [w for w in re.split(_BLANKS, text) if w]
    return text.split()


def _sections(c) -> Column:
    """A prompt cut before every line that begins with a bracketed header."""
    return F.split(_col(c), r"\n(?=\[[^\]\n]+\])", -1)


def _headed(section: Column, head: str) -> Column:
    return section.startswith(f"[{head}]")


def strip_block(c, head: str) -> Column:
    """The sections that do not stand under ``[head]``."""
    return F.rtrim(F.array_join(F.filter(_sections(c), lambda s: ~_headed(s, head)), "\n"))


def strip_from(c, head: str) -> Column:
    """The sections before ``[head]``."""
    sections = _sections(c)
    at = F.array_position(F.transform(sections, lambda s: _headed(s, head)), True)
    return F.rtrim(F.array_join(F.when(at == 0, sections).otherwise(F.slice(sections, F.lit(1), at.cast("int") - 1)), "\n"))


def absolute_links(c, base: str) -> Column:
    """Root-relative ``href`` and ``src`` targets get ``base`` in front."""
    return F.regexp_replace(_col(c), r'(href|src)="/([^"]*)"', f'$1="{base.rstrip("/")}/$2"')


def absolute_images(c, folder: str, base: str) -> Column:
    """Markdown image links under ``/folder/`` get ``base`` in front."""
    old, new = f"](/{folder}/", f"]({base.rstrip('/')}/{folder}/"

    def one(part: Column) -> Column:
        """What follows an image mark: label, target, rest."""
        close, link = F.locate("]", part), F.locate(old, part)
        target = F.substring_index(F.substring(part, link + len(old), F.length(part)), ")", 1)
        rest = F.substring(part, link + len(old), F.length(part))
        ours = (link > 0) & (link == close) & F.contains(rest, F.lit(")")) & (target != "")
        return F.when(ours, F.concat(F.substring(part, F.lit(1), link - 1), F.lit(new), rest)).otherwise(part)

    parts = F.split(_col(c), r"!\[", -1)
    return F.concat_ws("![", F.slice(parts, 1, 1), F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), one))


def parse_score(c) -> Column:
    """``score`` of a JSON object (0.0 without one), else the first number of the text from 0 to 1, else 0.0."""
    text = _col(c)
    numbers = F.transform(F.regexp_extract_all(text, F.lit("[0-9]+(?:[.][0-9]+)?"), F.lit(0)), lambda n: n.try_cast("double"))
    found = F.get(F.filter(numbers, lambda n: n.between(0.0, 1.0)), F.lit(0))
    member = F.get_json_object(text, "$.score")
    is_object = F.json_object_keys(text).isNotNull()
    from_object = F.when(member.isNull(), F.lit(0.0)).otherwise(F.coalesce(member.try_cast("double"), found, F.lit(0.0)))
    return F.when(is_object, from_object).otherwise(F.coalesce(found, F.lit(0.0)))


def strip_fences(c) -> Column:
    """The text between a leading code fence and its closing one; other text is returned unchanged."""
    text, fence = strip(c), "```"
    opened = F.substring(text, len(fence) + 1, 1 << 30)
    body = F.when(opened.startswith("markdown"), F.substring(opened, len("markdown") + 1, 1 << 30)).otherwise(opened)
    closed = F.when(body.endswith(fence), F.left(body, F.length(body) - len(fence))).otherwise(body)
    return F.when(text.startswith(fence), strip(closed)).otherwise(_col(c))


def failed_rules(c, rules: Mapping[str, str] = PASSWORD_RULES) -> Column:
    """Names of the rules whose pattern does not occur."""
    return F.array_compact(F.array(*[F.when(~_col(c).rlike(p), F.lit(n)) for n, p in rules.items()]))


def valid_form(name, gender, email, password, repeat) -> Column:
    return (
        (F.length(strip(name)) >= 2)
        & (F.length(_col(gender)) > 0)
        & _col(email).rlike(EMAIL)
        & (F.length(_col(password)) >= 6)
        & (_col(password) == _col(repeat))
    )


def script_class(c, first: str = HANGUL, second: str = LATIN) -> Column:
    """``first`` / ``second`` for pure text, then mixed, has_first, has_second, other."""
    text = strip(c)
    has1, has2 = text.rlike(f"[{first}]"), text.rlike(f"[{second}]")
    return (
        F.when(text.rlike(f"^[{first}]+$"), "first")
        .when(text.rlike(f"^[{second}]+$"), "second")
        .when(has1 & has2, "mixed")
        .when(has1, "has_first")
        .when(has2, "has_second")
        .otherwise("other")
    )


def band(c, bands: Sequence[tuple[float, str]] = BMI_BANDS, last: str = "obese") -> Column:
    """Label of the first band whose upper limit exceeds the value."""
    out = None
    for limit, name in bands:
        out = F.when(_col(c) < limit, name) if out is None else out.when(_col(c) < limit, name)
    return out.otherwise(last)


def bmi(weight_kg, height_cm) -> Column:
    return F.round(_col(weight_kg) / F.pow(_col(height_cm) / 100, F.lit(2)), 2)


def token_estimate(c) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(_col(c)) * 0.5).cast("int"))


def short_year_date(c) -> Column:
    """``yy/MM/dd`` where years 50-99 belong to the 1900s."""
    year = F.substring(_col(c), 1, 2).cast("int")
    century = F.when(year >= 50, "19").otherwise("20")
    return F.to_date(F.concat(century, _col(c)), "yyyy/MM/dd")


def page_text(html) -> Column:
    """Readable text of an HTML page."""
    text = F.regexp_replace(_col(html), r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def skewed_index(u, n) -> Column:
    """1..n with most draws on low numbers, from a uniform ``u``."""
    return (F.floor(F.pow(_col(u), F.lit(2)) * n) + 1).cast("bigint")
