"""Text functions as column expressions: all stay in the JVM, inside whole-stage code.

A null input gives null unless a docstring says otherwise; '' gives '' (or 0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HAN = "一-鿿"
HAN_A = "㐀-䶿"
#: Full-width signs and their ASCII forms in table texts.
FULL_WIDTH = "".join(chr(c) for c in (*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)))
HALF_WIDTH = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
TABLE_SIGNS, TABLE_ASCII = "：（），；", ":(),;"

# Units that may be split from a value; the single letters among them need more context.
UNITS = [
    "mm", "cm", "m", "km", "in", "ft", "L", "mL", "ml", "cc", "g", "kg", "lb", "oz", "Pa", "kPa", "MPa", "bar", "psi", "W", "kW", "hp", "V", "kV", "A", "mA", "Ah",
    "r/min", "rpm", "km/h", "mph", "m/s", "N·m", "℃", "℉", "°C", "°F", "s", "min", "h", "ms", "Hz", "kHz", "MHz", "FPS", "°",
]
AMBIGUOUS_UNITS = ["L", "W", "V", "A", "H", "K", "m", "s", "g"]
# Labels of device states, and keys that are no data.
STATE_LABELS = ["主界面", "电话", "菜单音乐", "音乐", "导航", "设置", "蓝牙", "FM", "AM", "USB", "AUX", "收音机", "通话", "联系人", "消息", "菜单", "返回", "确认", "取消", "音量", "静音", "语音"]
NO_DATA_KEYS = ["注意", "警告", "提示", "注"]

UNIT_END = r"\s*[（(]?([a-zA-Z·/℃²³%]+(?:·[a-zA-Z]+)?)[\s）)]?$"
MARKER_KEY = r"^[\s■▲●○◆◇★☆※\-—/\\|·]+$"
COLON_LINE = r"^(.{2,40})[：:]\s*(.{1,200})$"
MAIL = r"[\w.+-]+@[\w.-]+\.\w+"
PHONE = r"(?:电话|手机|联系电话)?\s*\d{3,4}[- ]\d{7,8}"
AMBIGUOUS_COLON = r"^注意[：:]|^警告[：:]|^提示[：:]|^注[：:]|信号|https?://|^[.\s…]+|^\d+\.\d+$|请.{5,}"
KEY_WORDS = ["项目", "参数", "名称", "部件", "规格"]
VALUE_WORDS = ["值", "规格", "说明", "参数", "性能", "尺寸"]
# Entities that are put back, in this order.
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&middot;", "·"), ("&times;", "×")]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """White space of any kind away from both ends; trim() takes spaces only."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def tokens(c: Column | str) -> Column:
    """Coverage tokens in order: runs of [a-z0-9] in lower case, and single ideographs."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(f"([a-z0-9]+|[{HAN}])"), F.lit(1))


def count_tokens(c: Column | str) -> Column:
    """Chunk tokens: ideographs with extension A, and runs of ASCII letters and digits."""
    return F.regexp_count(_col(c), F.lit(f"[{HAN}{HAN_A}]")) + F.regexp_count(_col(c), F.lit("[a-zA-Z0-9]+"))


def normalize(c: Column | str) -> Column:
    """Lower case without white space and punctuation."""
    return F.regexp_replace(F.lower(_col(c)), rf"[^a-z0-9{HAN}]+", "")


def collapse_lines(c: Column | str) -> Column:
    """Lines that repeat the line before them go away."""
    lines = F.split(_col(c), "\n", -1)
    kept = F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), F.when(i > 0, F.get(lines, i - 1)).alias("before"))), lambda s: s["before"].isNull() | (s["x"] != s["before"]))
    return F.array_join(F.transform(kept, lambda s: s["x"]), "\n")


def strip_html(c: Column | str) -> Column:
    """Style and script bodies away, block tags to spaces, other tags away, six entities back, spaces squeezed."""
    t = F.regexp_replace(_col(c), r"(?is)<(style|script)[^>]*>.*?</\1>", "")
    t = F.regexp_replace(t, r"(?i)</?(?:br|p|div|tr|td|th|li|table|thead|tbody|h[1-6])(?:\s[^>]*)?/?>", " ")
    t = F.regexp_replace(t, "<[^>]+>", "")
    for a, b in ENTITIES[:6]:
        t = F.replace(t, F.lit(a), F.lit(b))
    return strip(F.regexp_replace(t, r"\s+", " "))


def table_form(c: Column | str) -> Column:
    """Full-width letters, digits and signs to ASCII, white space away."""
    return F.regexp_replace(F.translate(F.translate(_col(c), FULL_WIDTH, HALF_WIDTH), TABLE_SIGNS, TABLE_ASCII), r"\s+", "")


def clean_inline(c: Column | str) -> Column:
    """Markdown emphasis, code and links to their text, in the order that decides overlaps."""
    t = _col(c)
    for pattern in (r"\*\*([^*]+)\*\*", "__([^_]+)__", r"\*([^*]+)\*", "_([^_]+)_", "`([^`]+)`", r"\[([^\]]+)\]\([^)]+\)"):
        t = F.regexp_replace(t, pattern, "$1")
    return t


def clean_tags(c: Column | str) -> Column:
    """Tags away and eight entities back."""
    t = F.regexp_replace(_col(c), "<[^>]+>", "")
    for a, b in ENTITIES:
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def clean_prose(c: Column | str) -> Column:
    """Heading marks, inline marks and tags away, then white space squeezed; tables and images are done before (operators.grids)."""
    t = clean_tags(clean_inline(F.regexp_replace(_col(c), r"(?m)^#{1,4}\s+", "")))
    return strip(F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), " {2,}", " "))


def split_unit(c: Column | str) -> Column:
    """struct(value, unit): a known unit at the end of a value is set apart; else the value as it is and ''."""
    v = _col(c)
    unit = F.regexp_extract(v, UNIT_END, 1)
    clean = strip(F.regexp_replace(strip(F.regexp_replace(v, UNIT_END, "")), ",+$", ""))
    known = F.array_contains(F.array(*map(F.lit, UNITS)), unit)
    vague = F.array_contains(F.array(*map(F.lit, AMBIGUOUS_UNITS)), unit)
    measured = ~clean.rlike(r"\d+[/]\d+|\d+[-]\d+") & clean.rlike(r"\d$")
    good = known & (clean != "") & (clean != v) & (~vague | measured)
    return F.struct(F.when(good, clean).otherwise(v).alias("value"), F.when(good, unit).otherwise(F.lit("")).alias("unit"))


def key_role(c: Column | str) -> Column:
    """marker, state_label, spec_value, local_label or business_key; null and blank are markers."""
    k = strip(F.coalesce(_col(c), F.lit("")))
    return (
        F.when((k == "") | k.rlike(MARKER_KEY), "marker")
        .when(k.isin(STATE_LABELS), "state_label")
        .when(k.rlike(r"^M\d+"), "spec_value")
        .when(k.rlike(r"^\d+$") | k.rlike(r"^\d+\s*[a-zA-Z·/℃²³%]+$"), "local_label")
        .otherwise("business_key")
    )


def colon_class(key: Column | str, value: Column | str) -> Column:
    """business_candidate, non_business or ambiguous for the two sides of a colon."""
    k, v = strip(key), strip(value)
    return (
        F.when((F.length(k) < 2) | (F.length(v) < 1) | (F.length(v) > 200), "ambiguous")
        .when(k.isin(NO_DATA_KEYS), "non_business")
        .when(v.rlike(MAIL) | v.rlike(PHONE), "non_business")
        .when(k.rlike(AMBIGUOUS_COLON) | v.rlike(AMBIGUOUS_COLON), "ambiguous")
        .otherwise("business_candidate")
    )


def uniform_row(cells: Column | str) -> Column:
    """At least six cells, none blank, all the same."""
    c = _col(cells)
    return (F.size(c) >= 6) & F.forall(c, lambda x: F.trim(x) != "") & (F.size(F.array_distinct(c)) == 1)


def title_form(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"(?U)\s+", "")


def path_parts(c: Column | str) -> Column:
    """Parts of a section path, divided by /, > or →, blanks left out."""
    return F.filter(F.transform(F.split(_col(c), "[/>→]"), strip), lambda x: x != "")


def snippet(text: Column | str, terms: list[str], around: int = 80) -> Column:
    """The first hit of any term with what stands around it, white space squeezed; '' without a hit."""
    t = _col(text)
    at = F.least(*[F.nullif(F.locate(x.lower(), F.lower(t)), F.lit(0)) for x in terms], F.lit(2**31 - 1), F.lit(2**31 - 1))
    start = F.greatest(at - around, F.lit(1))
    stop = at + around
    body = F.substring(t, start, stop - start)
    body = strip(F.regexp_replace(body, r"\s+", " "))
    return F.when(at == 2**31 - 1, "").otherwise(F.concat(F.when(start > 1, "…").otherwise(""), body, F.when(stop <= F.length(t), "…").otherwise("")))


def pages_listed(c: Column | str) -> Column:
    """A list like '13,31' as sorted different positive numbers; null if a part is none."""
    parts = F.transform(F.split(_col(c), ","), strip)
    good = F.forall(parts, lambda x: x.rlike(r"^[1-9]\d{0,8}$"))
    return F.when(good, F.array_sort(F.array_distinct(F.transform(parts, lambda x: x.try_cast("int")))))


def page_range(c: Column | str) -> Column:
    """struct(first, last) of '12', '12-14' or '14-12', with or without a prefix; nulls where no number stands."""
    p = _col(c)
    a = F.nullif(F.regexp_extract(p, r"(\d+)", 1), F.lit("")).try_cast("int")
    b = F.coalesce(F.nullif(F.regexp_extract(p, r"\d+\s*[-–—]\s*(\d+)", 1), F.lit("")).try_cast("int"), a)
    return F.struct(F.least(a, b).alias("first"), F.greatest(a, b).alias("last"))


def digest(*cols: Column | str, sep: str = "|") -> Column:
    """sha256 of the columns joined, null as ''; concat_ws alone would leave nulls out and change the digest."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]), 256)


def guess_column(headers: Column | str, words: list[str], default: Column) -> Column:
    """Place of the first header that holds one of the words."""
    h = _col(headers)
    hit = F.filter(F.transform(h, lambda x, i: F.when(x.rlike("|".join(words)), i)), lambda x: x.isNotNull())
    return F.when(F.size(h) < 2, default).otherwise(F.coalesce(F.try_element_at(hit, F.lit(1)), default))
