"""Text functions, as column expressions wherever Spark has the parts; Arrow UDFs only for NFKC, full entity tables and canonical JSON."""

from __future__ import annotations

import html
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's str counts it, spelled for Java and RE2 alike.
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

#: White space other than the blank.
WIDE_SPACE = SPACE.replace(r"\x{1c}-\x{20}", r"\x{1c}-\x{1f}")

# Tags that are taken out, text between them stays.
TAGS = "p|div|span|a|b|strong|em|i|u|ul|ol|li|table|thead|tbody|tfoot|tr|td|th|font|h[1-6]|hr|img|sub|sup|section|article|center"
BREAK_TAG = r"(?i)<br(\s[^>]*)?/?>"
ANY_TAG = rf"(?i)</?({TAGS})(\s[^>]*)?/?>"
CONTROLS = r"[\x{00}-\x{08}\x{0b}-\x{1f}\x{7f}-\x{9f}]"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))

# Punctuation that scoring takes for its ASCII form.
PUNCTUATION = {"，": ",", "、": ",", "。": ".", "；": ";", "：": ":", "！": "!", "？": "?", "（": "(", "）": ")", "“": '"', "”": '"', "‘": "'", "’": "'", "「": '"', "」": '"', "『": '"', "』": '"', "《": '"', "》": '"', "—": "-", "～": "~"}
SEPARATORS, SEPARATORS_NO_DUN = "[,，、;；]+", "[,，;；]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Takes white space of any kind off both ends."""
    return F.regexp_replace(_col(c), rf"^{SPACE}+|{SPACE}+$", "")


def squeeze(c: Column | str) -> Column:
    """One blank for each run of white space, none at the ends; null is empty. Single blanks between words are left as they are."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(_col(c), F.lit("")), rf"{SPACE}{{2,}}|{WIDE_SPACE}", " "), "^ | $", "")


def blank(c: Column | str) -> Column:
    """Whether a text is null or white space alone; the search ends at the first other character."""
    return F.coalesce(~F.regexp_like(_col(c), F.lit(SPACE.replace("[", "[^", 1))), F.lit(True))


def unescape(c: Column | str, rounds: int = 3) -> Column:
    """Decodes the entities of XML, as often as `rounds` says."""
    out = _col(c)
    for _ in range(rounds):
        for name, char in ENTITIES:
            out = F.replace(out, F.lit(name), F.lit(char))
    return out


@F.pandas_udf(T.StringType())
def _unescape_once(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def unescape_all(c: Column | str, rounds: int = 3) -> Column:
    """Decodes every named and numeric entity of HTML; only texts with & reach Python."""
    out = _col(c)
    for _ in range(rounds):
        out = F.when(F.contains(out, F.lit("&")), _unescape_once(out)).otherwise(out)
    return out


def clean(c: Column | str, rounds: int = 3, all_entities: bool = False) -> Column:
    """Decoded entities, <br> as line feed, known tags taken out, line feeds unified, tabs as blanks, controls taken out, ends stripped.

    Markup is only touched in texts that hold & or <. Null stays null.
    """
    c = _col(c)
    decoded = (unescape_all if all_entities else unescape)(c, rounds)
    plain = F.regexp_replace(F.regexp_replace(decoded, BREAK_TAG, "\n"), ANY_TAG, "")
    text = F.when(F.contains(c, F.lit("&")) | F.contains(c, F.lit("<")), plain).otherwise(c)
    text = F.replace(F.regexp_replace(text, r"\r\n?", "\n"), F.lit("\t"), F.lit(" "))
    return strip(F.regexp_replace(text, CONTROLS, ""))


def clean_nested(c: Column, kind, rounds: int = 3) -> Column:
    """`clean` for every string in a nested column of data type `kind`."""
    from pyspark.sql import types as T

    if isinstance(kind, T.StringType):
        return clean(c, rounds)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: clean_nested(x, kind.elementType, rounds))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(clean_nested(c[f.name], f.dataType, rounds).alias(f.name) for f in kind.fields)))
    return c


def lines_normal(c: Column | str) -> Column:
    """Line feeds unified, runs of blanks in a line as one, lines stripped, at most one empty line between others."""
    text = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"\r\n?", "\n")
    text = F.regexp_replace(F.regexp_replace(text, "[ \t\f\x0b]+", " "), "(?m)^ | $", "")
    return F.regexp_replace(F.regexp_replace(text, "\n{3,}", "\n\n"), r"^\s+|\s+$", "")


@F.pandas_udf(T.StringType())
def canonical(s: pd.Series) -> pd.Series:
    """NFKC, without white space, case folded; null is empty."""
    return s.map(lambda x: re.sub(r"\s+", "", unicodedata.normalize("NFKC", x or "")).casefold())


@F.pandas_udf(T.StringType())
def _scoring(s: pd.Series) -> pd.Series:
    table = str.maketrans(PUNCTUATION)
    return s.map(lambda x: " ".join(unicodedata.normalize("NFKC", x or "").translate(table).lower().split()))


def scoring_normal(c: Column | str, ascii_only: bool = False) -> Column:
    """The form that answers are compared in. `ascii_only` leaves out NFKC and stays in the JVM."""
    c = F.coalesce(_col(c), F.lit(""))
    if not ascii_only:
        return _scoring(c)
    return squeeze(F.lower(F.translate(c, "".join(PUNCTUATION), "".join(PUNCTUATION.values()))))


def tokens(c: Column | str) -> Column:
    """Runs of a-z and 0-9, and every other letter or digit by itself."""
    found = F.regexp_extract_all(_col(c), F.lit(r"([a-z0-9]+|[^a-z0-9\s])"), F.lit(1))
    return F.filter(found, lambda t: F.regexp_like(t, F.lit(r"^[\p{L}\p{N}]+$")))


def numbered_tokens(c: Column) -> Column:
    """Each token with its number among its equals, so that bags compare as sets. Tokens hold no white space."""
    runs = F.regexp_extract_all(F.array_join(F.sort_array(c), " "), F.lit(r"(\S+)(?: \1(?!\S))*"), F.lit(0))
    return F.flatten(F.transform(runs, lambda run: F.transform(F.split(run, " "), lambda t, k: F.concat(t, F.lit(" "), k.cast("string")))))


def bag_f1(a: Column, b: Column) -> Column:
    """F1 of two token arrays as bags: 1 if both are empty, 0 if one is. Time grows with the number of tokens, but for their sorting."""
    same = F.size(F.array_intersect(numbered_tokens(a), numbered_tokens(b)))
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(2.0 * same / both)


def split_values(c: Column | str, separators: str = SEPARATORS) -> Column:
    """The squeezed, non-empty, distinct values of a cell in their order."""
    parts = F.transform(F.split(F.coalesce(_col(c), F.lit("")), separators), squeeze)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def first_filled(*cs: Column | str) -> Column:
    """The first value that is neither null nor empty, else empty."""
    return F.coalesce(*(F.nullif(_col(c), F.lit("")) for c in cs), F.lit(""))


def yes_no(c: Column | str) -> Column:
    return F.when(_col(c), F.lit("是")).when(~_col(c), F.lit("否")).otherwise(F.lit(""))


def with_unit(amount: Column | str, unit: Column | str) -> Column:
    """`5` and `days` as `5个days`, unless the amount ends so already."""
    amount, unit = F.coalesce(_col(amount), F.lit("")), F.coalesce(_col(unit), F.lit(""))
    return F.when(amount == "", "").when((unit == "") | F.endswith(amount, unit), amount).otherwise(F.concat(amount, F.lit("个"), unit))


def cut(c: Column | str, n: int) -> Column:
    """At most n characters, with a mark where something was cut off."""
    return F.when(F.length(_col(c)) > n, F.concat(F.substring(_col(c), 1, n), F.lit("…"))).otherwise(_col(c))


def unquote(c: Column | str) -> Column:
    return F.regexp_replace(strip(c), "^[\"'“”‘’]+|[\"'“”‘’]+$", "")


def numbered(items: Column) -> Column:
    """`1. a` and so on, a line each."""
    return F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def display_name(law: Column | str, article: Column | str) -> Column:
    return F.concat_ws(" ", F.nullif(_col(law), F.lit("")), F.nullif(_col(article), F.lit("")))


def required_label(c: Column | str) -> Column:
    """The mark of a requirement: values that say no, and all others."""
    return F.when(strip(F.coalesce(_col(c), F.lit(""))).isin("否", "非必要", "非必需", "false", "False", "FALSE", "0", "no", "No"), "（非必要）").otherwise("（必要）")


def iso_seconds(c: Column | str) -> Column:
    """Seconds of a duration such as PT1H19M48.888S; 0 if it is none."""
    part = lambda unit: F.coalesce(F.regexp_extract(_col(c), rf"([0-9.]+){unit}", 1).try_cast("double"), F.lit(0.0))
    return F.when(F.regexp_like(_col(c), F.lit(r"^PT")), part("H") * 3600 + part("M") * 60 + part("S")).otherwise(0.0)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, "N/A").otherwise(F.format_string("%.1f%%", part * 100.0 / whole))


@F.pandas_udf(T.StringType())
def canonical_json(s: pd.Series) -> pd.Series:
    """JSON text with sorted keys and the usual separators; null and broken text stay null."""

    def one(x):
        try:
            return json.dumps(json.loads(x), ensure_ascii=False, sort_keys=True)
        except (TypeError, ValueError):
            return None

    return s.map(one)


@F.pandas_udf(T.IntegerType())
def json_length(s: pd.Series) -> pd.Series:
    """Length of the value's JSON text as written with the usual separators; null and empty text have 0, broken text null."""

    def one(x):
        try:
            return len(json.dumps(json.loads(x), ensure_ascii=False)) if x else 0
        except ValueError:
            return None

    return s.map(one).astype("Int32")


def json_array_text(c: Column | str) -> Column:
    """What stands from the first [ to the last ] of a reply, fences or not; null if there is none."""
    return F.nullif(F.regexp_extract(_col(c), r"(?s)(\[.*\])", 1), F.lit(""))


def json_object_text(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(c), r"(?s)(\{.*\})", 1), F.lit(""))


def one_line(c: Column | str, kind: T.DataType) -> Column:
    """A value of any type as one cell: null is empty, booleans true or false, structures compact JSON, other values stripped."""
    c = _col(c)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.to_json(c, {"ignoreNullFields": "false"}), F.lit(""))
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def split_quoted(c: Column | str, separator: str = ",") -> Column:
    """The fields of a row of text: separators between quotes don't count; quotes and white space around a field go."""
    parts = F.split(_col(c), separator + r'(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(parts, lambda x: F.regexp_replace(strip(x), '^"+|"+$', ""))


def record_hash(text: Column | str, own: str) -> Column:
    """SHA-256 of a JSON object's canonical text with its own top-level hash field set empty."""
    return F.sha2(canonical_json(F.to_json(F.map_concat(F.map_filter(F.from_json(_col(text), "map<string,string>"), lambda k, v: k != own), F.create_map(F.lit(own), F.lit(""))))), 256)
