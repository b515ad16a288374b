"""String expressions over asset names, paths, keys and listing lines. All are built-in column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes and patterns of asset names.
ID_PREFIXES = ("avg_", "char_", "avgnew_", "npc_")
MATCHABLE = r"(?i)^avg_\d+_.+|^char_\d+_.*"
NUMERIC_ID = r"(?i)^(?:avg|char)_(\d+)_"
LS_LINE = r"^\S+\s+\d+\s+\S+\s+\S+\s+(\d+)\s+\S+\s+\S+\s+(.+)$"
UNZIP_LINE = r"^\s*(\d+)\s+\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}\s+(.+?)\s*$"


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def matchable(name) -> Column:
    """Whether a name is one that candidates can be sought for."""
    return c(name).rlike(MATCHABLE)


def numeric_id(name) -> Column:
    """The digits after the kind prefix; null without them."""
    return F.nullif(F.regexp_extract(c(name), NUMERIC_ID, 1), F.lit(""))


def has_id_prefix(name) -> Column:
    low = F.lower(c(name))
    out = F.lit(False)
    for p in ID_PREFIXES:
        out = out | low.startswith(p)
    return out


def without_variant(name) -> Column:
    """The name without a trailing _<digits>."""
    return F.regexp_replace(c(name), r"_\d+$", "")


def without_png(name) -> Column:
    """The name without any trailing .png, repeated or in capitals."""
    return F.regexp_replace(c(name), r"(?i)(\.png)+$", "")


def stem(name) -> Column:
    """The name without its last extension; a leading dot begins no extension."""
    return F.regexp_replace(c(name), r"(?<=.)\.[^.]*$", "")


def base_name(path) -> Column:
    return F.regexp_extract(c(path), r"[^/]+$", 0)


def first_segment(path) -> Column:
    return F.substring_index(c(path), "/", 1)


def dollar_number(name) -> Column:
    """n of a trailing $n; null without it."""
    return F.nullif(F.regexp_extract(c(name), r"\$(\d+)$", 1), F.lit("")).cast("int")


def first_in_sequence(name) -> Column:
    """$n counts as first; [#_]n only if n is 1; a bare name does."""
    n = F.regexp_extract(c(name), r"[#_](\d+)$", 1)
    return F.when(c(name).rlike(r"\$\d+$"), True).when(n != "", n == "1").otherwise(True)


def common_prefix(a, b) -> Column:
    """The longest common prefix of two strings."""
    a, b = c(a), c(b)
    n = F.least(F.length(a), F.length(b))
    at = F.filter(F.sequence(F.lit(0), n), lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i))
    return F.substring(a, F.lit(1), F.array_max(at))


def skip_key(x) -> Column:
    """Normal form of a skip-list key: trimmed and lower case (letters that fold to two stay as they are)."""
    return F.lower(F.trim(c(x)))


def sprite_key(x) -> Column:
    """Normal form of a sprite: its stem, trimmed and lower case."""
    return skip_key(stem(F.trim(c(x))))


def fold_dots(x) -> Column:
    """Runs of dots become one, so no path climbs."""
    return F.regexp_replace(c(x), r"\.{2,}", ".")


def safe_file(x) -> Column:
    return F.translate(c(x), "$#", "__")


def glob_regex(pattern: str) -> str:
    """A shell pattern as a regular expression in which * and ? also match a slash."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "[" and (end := pattern.find("]", i + 2)) > 0:
            body = pattern[i + 1 : end]
            out.append("[" + ("^" + body[1:] if body[0] == "!" else body).replace("\\", "\\\\") + "]")
            i = end
        else:
            out.append({"*": ".*", "?": "."}.get(ch, re.escape(ch)))
        i += 1
    return "(?s)^(?:" + "".join(out) + ")$"


def excluded(path, patterns: list[str]) -> Column:
    """Whether a path is one of the patterns or lies below one."""
    out = F.lit(False)
    for p in patterns:
        out = out | c(path).rlike(glob_regex(p)) | c(path).rlike(glob_regex(p.rstrip("/") + "/*"))
    return out


def is_alpha_texture(path) -> Column:
    return F.lower(base_name(path)) == "alpha.png"


def digest(content) -> Column:
    """SHA-256 of a content or text, in lower-case hexadecimal."""
    return F.sha2(c(content), 256)


def version_token(version_name, version_code) -> Column:
    """The digits of the name, else the code."""
    return F.coalesce(F.nullif(F.regexp_replace(c(version_name), r"\D", ""), F.lit("")), c(version_code).cast("string"))


def package_of(location, default: str) -> Column:
    """The package of an install location (…/<package>-<suffix>/base.apk or …/data/<package>/…), else the default."""
    found = F.regexp_extract(c(location), r"(?:/data/app/(?:~~[^/]+/)?|/Android/data/)([A-Za-z]\w*(?:\.\w+)+)(?=[-/])", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(default))


def byte_text(n) -> Column:
    """A byte count for people; ties go to the even tenth, as printf rounds them (exact below 2^49), where format_string alone rounds up. Null for null."""
    n = c(n).cast("double")
    part = lambda unit, size: F.format_string(f"%.1f {unit}", F.rint(n / size * 10) / 10)
    text = F.when(n < 1024, F.format_string("%d B", n.cast("long"))).when(n < 1024**2, part("KB", 1024)).when(n < 1024**3, part("MB", 1024**2))
    return F.when(n.isNotNull(), text.otherwise(part("GB", 1024**3)))


def elapsed_text(seconds) -> Column:
    s = F.rint(c(seconds)).cast("long")
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm%02ds", F.expr("0L") + F.floor(s / 60), s % 60)).otherwise(
        F.format_string("%dh%02dm", F.floor(s / 3600), F.floor((s % 3600) / 60))
    )
