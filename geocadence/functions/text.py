"""Text parsing as Column expressions: ranges, names, paths, labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from geocadence.functions.geo import once

_DASH = "[-–]"


def parse_range(text: Column) -> Column:
    """P16. ``"3-5"`` -> {3,5}; ``"14+"`` -> {14,NULL}; a plain or an en dash may separate."""
    t = F.trim(text)
    lo = F.regexp_extract(t, r"^(\d+)", 1).try_cast("int")
    hi = F.regexp_extract(t, rf"^\d+\s*{_DASH}\s*(\d+)$", 1).try_cast("int")
    return F.struct(lo.alias("lo"), hi.alias("hi"))


def split_list(text: Column) -> Column:
    """P16. Comma list to a trimmed array."""
    return F.transform(F.split(text, ","), lambda s: F.trim(s))


def threshold_text(lo: Column, hi: Column, name: str = "n") -> Column:
    """C4. Text shown beside an alert level."""
    lo_s, hi_s = lo.cast("string"), hi.cast("string")
    return (
        F.when(hi.isNull(), F.concat(F.lit(f"{name} >= "), lo_s))
        .when(lo == hi, F.concat(F.lit(f"{name} = "), lo_s))
        .otherwise(F.concat(lo_s, F.lit(f" <= {name} <= "), hi_s))
    )


def rgba_text(r: Column, g: Column, b: Column, opacity: Column, absent: str = "") -> Column:
    """P25. ``"r,g,b,opacity"``; a level without colour gives `absent`."""
    joined = F.concat_ws(",", r.cast("string"), g.cast("string"), b.cast("string"), opacity.cast("string"))
    return F.when(r.isNull() | g.isNull() | b.isNull(), F.lit(absent)).otherwise(joined)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


# --- P17: times carried by file names ------------------------------------------------------------
def stamp12(text: Column) -> Column:
    """A 12-digit yyyyMMddHHmm text to a naive time, NULL when it is not a valid time."""
    iso = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:00")
    return F.regexp_extract(iso, r"^\d{4}-\d\d-\d\d \d\d:\d\d:00$", 0).try_cast("timestamp_ntz")


def time_from_token(path: Column, position: int = 2) -> Column:
    """Time in the given ``_`` token of the file stem (0-based)."""
    return stamp12(F.get(F.split(stem(path), "_"), F.lit(position)))


def time_from_digits(path: Column) -> Column:
    """Time in the first run of twelve digits of the file name."""
    return stamp12(F.regexp_extract(base_name(path), r"(\d{12})", 1))


def time_from_regex(path: Column, pattern: str) -> Column:
    """Time from a user pattern with named groups ``ts`` or ``YYYY MM DD [HH] [mm]``."""
    groups = re.compile(pattern).groupindex
    java = re.sub(r"\(\?P<", "(?<", pattern)
    name = base_name(path)

    def part(key: str, default: str) -> Column:
        if key not in groups:
            return F.lit(default)
        return F.regexp_extract(name, java, groups[key])

    if "ts" in groups:
        return stamp12(part("ts", ""))
    return stamp12(F.concat(part("YYYY", ""), part("MM", ""), part("DD", ""), part("HH", "00"), part("mm", "00")))


def info_run_time(path: Column) -> Column:
    """Time of an ``info_run_{yyyyMMdd}_{HHmm}.json`` name."""
    name = base_name(path)
    pattern = r"^info_run_(\d{8})_(\d{4})\.json$"
    return stamp12(F.concat(F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)))


# --- P18: times carried by folders ---------------------------------------------------------------
# fixed values: the supported strftime tokens and the text they match
_TOKENS = {"%Y": r"(\d{4})", "%m": r"(\d{2})", "%d": r"(\d{2})", "%H": r"(\d{2})", "%M": r"(\d{2})"}
_STAR_BY_LEVEL = ("%Y", "%m", "%d", "%H")


def fill_star(pattern: str) -> str:
    """A ``*`` takes the token of its folder level: year, month, day, then hour."""
    levels = pattern.split("/")
    return "/".join(
        level.replace("*", _STAR_BY_LEVEL[min(i, 3)]) for i, level in enumerate(levels)
    )


def time_from_path(path: Column, pattern: str = "%Y/%m/%d/%H%M") -> Column:
    """Naive time found in a path by a strftime-like folder pattern; absent parts start at 1 or 0."""
    pattern = fill_star(pattern)
    order: list[str] = []
    regex = ""
    for piece in re.split(r"(%[A-Za-z])", pattern):
        if piece in _TOKENS:
            order.append(piece)
            regex += _TOKENS[piece]
        elif piece.startswith("%") and len(piece) == 2:
            raise ValueError(f"unsupported token {piece!r} in {pattern!r}")
        else:
            regex += re.escape(piece)
    if regex.endswith("/"):
        regex += "?"

    def part(token: str, default: str) -> Column:
        if token not in order:
            return F.lit(default)
        return F.regexp_extract(path, regex, order.index(token) + 1)

    return stamp12(F.concat(part("%Y", "1900"), part("%m", "01"), part("%d", "01"), part("%H", "00"), part("%M", "00")))


def fill_template(template: str, parts: dict[str, Column]) -> Column:
    """S12. ``{name}`` place holders of a path template replaced by text columns."""
    pieces = re.split(r"\{([^{}]+)\}", template)
    out = [F.lit(p) if i % 2 == 0 else parts[p].cast("string") for i, p in enumerate(pieces)]
    return F.concat(*out)


def dated_folder(c: Column, pattern: str = "%Y/%m/%d/") -> Column:
    """S12. Folder text of a time by a strftime-like pattern."""
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return fill_template(
        re.sub(r"%([YmdHM])", r"{\1}", pattern),
        {"Y": F.year(c), "m": two(F.month(c)), "d": two(F.dayofmonth(c)), "H": two(F.hour(c)), "M": two(F.minute(c))},
    )


# --- P26 -----------------------------------------------------------------------------------------
def run_label(text: Column) -> Column:
    """``HHMM``, ``HH:MM`` or ``HH:MM:SS`` to ``HH:MM``; anything else or out of range is NULL."""
    # one chain, so that the text is evaluated once: pad the hour, drop seconds, keep digits, check the range
    padded = F.regexp_replace(F.trim(text), r"^(\d):(\d{2})(:\d{2})?$", "0$1:$2$3")
    digits = F.regexp_replace(F.regexp_replace(padded, r"^(\d{2}:\d{2}):\d{2}$", "$1"), "[^0-9]", "")
    label = F.regexp_replace(digits, r"^([01]\d|2[0-3])([0-5]\d)$", "$1:$2")
    return F.nullif(F.regexp_extract(label, r"^\d\d:\d\d$", 0), F.lit(""))


def run_label_from_json(doc: Column, depth: int = 3) -> Column:
    """Run label of the first ``run_time`` in the document, searched through objects and lists ``depth`` levels down.

    An object that has the key answers for all below it; a value that is no label gives NULL there.
    """
    texts = F.from_json(doc, "map<string,string>")
    is_object, is_list = F.ltrim(doc).startswith("{"), F.ltrim(doc).startswith("[")
    own = F.when(is_object, texts["run_time"])
    if not depth:
        return run_label(own)
    below = F.when(is_object, F.map_values(texts)).when(is_list, F.from_json(doc, "array<string>")).otherwise(F.array().cast("array<string>"))
    found = F.filter(F.transform(below, lambda part: run_label_from_json(part, depth - 1)), lambda label: label.isNotNull())
    return F.when(own.isNotNull(), run_label(own)).otherwise(F.get(found, F.lit(0)))


def run_label_from_name(path: Column) -> Column:
    """``…YYYYMMDD_HHMM…`` first, then any free-standing four digits."""
    def digits(s: Column) -> Column:
        dated = F.nullif(F.regexp_extract(s, r"\d{8}[_-](\d{4})", 1), F.lit(""))
        return F.coalesce(dated, F.nullif(F.regexp_extract(s, r"(?<!\d)(\d{4})(?!\d)", 1), F.lit("")))

    return once(once(stem(path), digits), run_label)


def run_label_of(path: Column, doc: Column | None = None) -> Column:
    """Run label of a file: from its JSON text when it holds one, else from its name."""
    by_name = run_label_from_name(path)
    return by_name if doc is None else F.coalesce(run_label_from_json(doc), by_name)


def time_reference(day: Column, label: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` of a reference day and a run label."""
    return F.concat(day.cast("date").cast("string"), F.lit(" "), label)


def label_minutes(label: Column) -> Column:
    return once(label, lambda text: F.substring(text, 1, 2).cast("int") * 60 + F.substring(text, 4, 2).cast("int"))


# --- P27 / P27b ----------------------------------------------------------------------------------
def has_all_tags(path: Column, tags: list[str]) -> Column:
    ok = F.lit(True)
    for tag in tags:
        ok = ok & F.contains(F.lower(base_name(path)), F.lit(tag.lower()))
    return ok


def is_me_file(path: Column) -> Column:
    n = F.lower(base_name(path))
    return n.startswith("me") & n.endswith(".json")


def is_mc_file(path: Column) -> Column:
    n = F.lower(base_name(path))
    return F.contains(n, F.lit("meteo")) & F.contains(n, F.lit("check")) & n.endswith(".json")
