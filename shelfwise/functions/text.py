"""Column expressions for names, codes, dates and addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Characters, words and patterns that results depend on.
QUOTE_MARKS = "\"'״׳"
APOSTROPHES = "[’׳`]"
NOT_A_WORD = r"[^\p{L}\p{N}_֐-׿]+"
QUOTED_WORD = r"[\p{L}\p{N}_\"'״׳]+"
HEBREW_LETTER = "[א-ת]"
STREET_WORD = r"^(רחוב|שדרות|רח\"|רח'|שד'|רח|שד)(?=\s)\s*"
STREET_PREFIXES = ["רח'", 'רח"', "רחוב", "שד'", "שדרות"]
ADDRESS_MARKS = "[\"'׳״`]"
COUNTRY = "ישראל"
CATEGORY_ROOT = "קטגוריות"
UNKNOWN_UNIT = "לא ידוע"
BRANCH_WORD = "סניף"
NO_CITY = ("", "0", "unknown")
NO_ADDRESS = ("", "unknown")
TRUE_WORDS = ("1", "true", "True")
FILE_STAMP = r"(\d{8})[-_]?(\d{4,6})(?!.*\d)"
FILE_KIND = r"^([A-Za-z]+?)\d"
IMAGE_BARCODE = r"/gs1-products/1062/[^/]+/(\d{8,14})-\d+/\1/"
IMAGE_BARCODE_LOOSE = r"/gs1-products/1062/[^/]+/(\d{8,14})-"
DOWNLOAD_LINK = r"/Prices/Download\?fileName=([^\"'&<>]+)"
FULL_SNAPSHOT = r"(?i)^(PriceFull|PromoFull|Stores)"
EXPORT_NAME = r"^[A-Za-z]+\d{13}(-\d+(-\d+)?-\d{8}-\d{4,6}|-\d+-\d{12,14})(\.[A-Za-z]+)*$"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def pick(df: DataFrame, *names: str) -> Column:
    """First non-empty value among the spellings that ``df`` has."""
    have = {c.lower(): c for c in df.columns}
    found = [blank_to_null(F.col(f"`{have[n]}`")) for n in names if n in have]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def number(c: Column) -> Column:
    """Tolerant text to double; not-a-number and infinities are null."""
    value = F.regexp_replace(F.trim(c), ",", "").try_cast("double")
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(finite, value)


def store_code(c: Column) -> Column:
    """Branch code without leading zeros; all zeros is branch ``0``."""
    return F.coalesce(blank_to_null(F.regexp_replace(c, "^0+", "")), F.lit("0"))


def flag(c: Column) -> Column:
    return F.coalesce(F.trim(c).isin(*TRUE_WORDS).cast("int"), F.lit(0))


def day(c: Column) -> Column:
    """Date part of a timestamp text; empty or malformed is null (open)."""
    return F.substring(F.trim(c), 1, 10).try_cast("date")


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalise(c: Column) -> Column:
    bare = F.translate(F.coalesce(c, F.lit("")), QUOTE_MARKS, "")
    return squeeze(F.lower(bare))


def tokens(c: Column) -> Column:
    """Words of two or more characters, in order, repeats kept."""
    words = F.split(normalise(c), NOT_A_WORD)
    return F.filter(words, lambda w: F.length(w) >= 2)


def term_counts(c: Column) -> Column:
    """Array of (token, tf) structs of a text: sorted words cut into runs."""
    def runs(words):
        starts = F.filter(F.transform(words, lambda w, i: F.when(
            F.coalesce(F.get(words, i - 1) != w, F.lit(True)), i)), lambda i: i.isNotNull())
        return F.get(F.transform(F.array(starts), lambda at: F.transform(at, lambda p, j: F.struct(
            F.get(words, p).alias("token"),
            (F.coalesce(F.get(at, j + 1), F.size(words)) - p).alias("tf")))), F.lit(0))

    return F.get(F.transform(F.array(F.sort_array(tokens(c))), runs), F.lit(0))


def raw_tokens(c: Column) -> Column:
    """Distinct words of two or more characters; quotes act as separators."""
    words = F.split(F.lower(F.coalesce(c, F.lit(""))), NOT_A_WORD)
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= 2))


def name_terms(c: Column) -> Column:
    """Words a name shard is keyed by: quotes kept inside, never all digits."""
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(QUOTED_WORD), 0)
    usable = F.filter(
        words,
        lambda w: (F.length(w) >= 2) & ~w.rlike(r"^\p{Nd}+$") & w.rlike(r"^[\p{L}\p{N}]"),
    )
    return F.array_distinct(usable)


def unescape_name(c: Column) -> Column:
    """Undo CSV escaping that leaked into a name; lone quotes stay."""
    inner = F.regexp_replace(F.trim(c), '^"(.*)"$', "$1")
    return F.trim(F.regexp_replace(inner, '"{2,}', '"'))


def display_unit(is_weighted: Column, unit: Column) -> Column:
    real = F.nullif(blank_to_null(F.trim(unit)), F.lit(UNKNOWN_UNIT))
    return F.when(is_weighted == 1, real)


def store_label(store_id: Column, name: Column, city: Column) -> Column:
    numeric_city = F.coalesce(city, F.lit("")).rlike(r"^\d*$")
    return (
        F.when(blank_to_null(name).isNull(), F.concat_ws(" ", F.lit(BRANCH_WORD), store_id))
        .when(numeric_city, name)
        .otherwise(F.concat_ws(" · ", name, city))
    )


def barcode_candidates(c: Column) -> Column:
    """Codes to try for a scan, best first."""
    code = digits(F.coalesce(c, F.lit("")))
    tail = F.substr(code, F.lit(7))
    internal = code.startswith("729000") & (F.length(code) > 6)
    bare = F.regexp_replace(tail, "^0+", "")
    tries = F.array(
        code,
        F.when(internal, tail),
        F.when(internal, blank_to_null(bare)),
        F.when((F.length(code) == 13) & code.startswith("0"), F.substr(code, F.lit(2))),
    )
    return F.array_distinct(F.filter(tries, lambda t: t.isNotNull() & (t != "")))


def barcode_variants(c: Column) -> Column:
    """A barcode with and without the internal prefix, as given first."""
    internal = c.startswith("729000") & (F.length(c) > 6)
    other = F.when(internal, F.substr(c, F.lit(7))).otherwise(F.concat(F.lit("729000"), c))
    return F.array(c, other)


# --- files and links ---------------------------------------------------------


def file_stamp(name: Column) -> Column:
    """Last date-shaped run of a name as fourteen digits; null without one."""
    found = F.translate(F.regexp_extract(name, FILE_STAMP, 0), "-_", "")
    return F.rpad(blank_to_null(found), 14, "0")


def file_kind(name: Column) -> Column:
    return blank_to_null(F.lower(F.regexp_extract(name, FILE_KIND, 1)))


def image_barcode(url: Column) -> Column:
    return F.coalesce(
        blank_to_null(F.regexp_extract(url, IMAGE_BARCODE, 1)),
        blank_to_null(F.regexp_extract(url, IMAGE_BARCODE_LOOSE, 1)),
    )


def path_parts(path: Column) -> Column:
    return F.filter(F.split(F.coalesce(path, F.lit("")), ">"), lambda p: p != "")


def url_path(url: Column) -> Column:
    """Struct of category ``path`` and product ``name`` from a product address."""
    parts = F.filter(
        F.split(F.coalesce(url, F.lit("")), "/"), lambda p: p != ""
    )
    parts = F.transform(parts, lambda p: F.coalesce(F.try_url_decode(p), p))
    # Trailing id segments: "p" and "P_<sku>"; cut after the last other segment.
    kept = F.aggregate(
        F.transform(parts, lambda p, i: F.when((p == "p") | p.startswith("P_"), 0).otherwise(i + 1)),
        F.lit(0),
        lambda a, b: F.greatest(a, b),
    )
    parts = F.slice(parts, F.lit(1), kept)
    rooted = F.get(parts, F.lit(0)) == CATEGORY_ROOT
    parts = F.when(rooted, F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
    path = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), ">")
    name = F.coalesce(F.translate(F.try_element_at(parts, F.lit(-1)), "-", " "), F.lit(""))
    return F.struct(path.alias("path"), name.alias("name"))


def category_path(categories: Column) -> Column:
    """Path text from an array of structs with a ``name`` field."""
    names = F.transform(categories, lambda c: c["name"])
    return F.array_join(F.filter(names, lambda n: n.isNotNull() & (n != "")), ">")


# --- addresses ---------------------------------------------------------------


def has_address(raw: Column) -> Column:
    return ~F.lower(squeeze(F.coalesce(raw, F.lit("")))).isin(*NO_ADDRESS)


def address_query(address: Column, city: Column) -> Column:
    full = F.concat_ws(", ", address, city, F.lit(COUNTRY))
    return F.when(blank_to_null(city).isNotNull(), full).otherwise(address)


def _literal_pattern(c: Column) -> Column:
    return F.concat(F.lit("\\Q"), F.regexp_replace(c, r"\\E", ""), F.lit("\\E"))


def clean_address(address: Column, city: Column) -> Column:
    """Struct of the cleaned ``address`` and the ``rules`` that changed it."""
    town = F.coalesce(city, F.lit(""))
    one_word = F.concat(F.lit("(?<![א-ת])"), _literal_pattern(town), F.lit("(?![א-ת])"))
    steps = [
        ("normalize_punctuation", lambda a: squeeze(
            F.regexp_replace(F.regexp_replace(a, APOSTROPHES, "'"), r"([א-ת])(\d)", "$1 $2"))),
        ("strip_street_prefix", lambda a: F.regexp_replace(a, STREET_WORD, "")),
        ("drop_trailing_clause", lambda a: F.trim(F.substring_index(a, ",", 1))),
        ("drop_duplicate_city", lambda a: F.when(town == "", a).otherwise(
            squeeze(F.regexp_replace(a, one_word, F.lit(" "))))),
    ]
    state = F.struct(F.coalesce(address, F.lit("")).alias("address"),
                     F.array().cast("array<string>").alias("rules"))
    # Each rule runs once on the previous state; an array of one element lets
    # the next step name that state without repeating its expression.
    def step(rule, change):
        def advance(s):
            new = change(s["address"])
            fired = (new != s["address"]) & new.rlike(HEBREW_LETTER)
            rules = F.array_append(s["rules"], F.lit(rule))
            return F.when(fired, F.struct(new.alias("address"), rules.alias("rules"))).otherwise(s)

        return advance

    for rule, change in steps:
        state = F.get(F.transform(F.array(state), step(rule, change)), F.lit(0))
    return state


def street_number(address: Column) -> Column:
    """Street and first house number, or null when either is missing."""
    head = squeeze(blank_to_null(F.regexp_extract(address, r"^(.*?\d+)", 1)))
    return F.when(head.rlike(HEBREW_LETTER), head)


def address_attempts(address: Column, city: Column) -> Column:
    """New queries worth trying, most faithful first, without repeats."""
    def plan(s):
        cleaned = address_query(s["address"], city)
        narrow = street_number(s["address"])
        narrow_query = address_query(narrow, city)
        original = address_query(address, city)
        first = F.when(cleaned != original, F.struct(
            F.lit("cleaned").alias("stage"), cleaned.alias("query"), s["rules"].alias("rules")))
        second = F.when(
            narrow.isNotNull() & (narrow_query != original) & (narrow_query != cleaned),
            F.struct(
                F.lit("street_number").alias("stage"), narrow_query.alias("query"),
                F.array_append(s["rules"], F.lit("street_plus_number")).alias("rules")))
        return F.filter(F.array(first, second), lambda a: a.isNotNull())

    return F.get(F.transform(F.array(clean_address(address, city)), plan), F.lit(0))


def _without_city(address: Column, city: Column) -> Column:
    """Address without a trailing or leading ``, city`` in any dash spelling."""
    a = F.trim(F.coalesce(address, F.lit("")))
    c = F.trim(F.coalesce(city, F.lit("")))
    spellings = [
        c,
        F.replace(c, F.lit(" - "), F.lit("-")),
        F.replace(c, F.lit("-"), F.lit(" - ")),
        F.replace(c, F.lit("-"), F.lit(" ")),
    ]
    for name in spellings:
        quoted = _literal_pattern(F.trim(name))
        tail = F.concat(F.lit(r"(, | ,|,)"), quoted, F.lit("$"))
        head = F.concat(F.lit("^"), quoted, F.lit(","))
        stripped = F.trim(F.regexp_replace(F.trim(F.regexp_replace(a, tail, F.lit(""))), head, F.lit("")))
        a = F.when(F.trim(name) == "", a).otherwise(stripped)
    return a


def address_key(address: Column, city: Column | None = None) -> Column:
    """Form under which two spellings of one address are equal."""
    a = F.trim(F.coalesce(address, F.lit("")))
    if city is not None:
        a = _without_city(a, city)
    prefix = "^(" + "|".join(STREET_PREFIXES) + ")"
    a = F.trim(F.regexp_replace(a, prefix, ""))
    a = F.regexp_replace(a, ADDRESS_MARKS, "")
    a = F.trim(F.regexp_replace(a, "[.,]+$", ""))
    a = F.regexp_replace(a, r"(?<=[א-ת])(?=\d)", " ")
    a = F.regexp_replace(a, r"(?<=\d)(?=[א-ת])", " ")
    return squeeze(a)
