"""Scalar functions as expressions: dirty dates, prices and names, keys and formats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from furrow.data import load

_WORDS = load("words")
STATE_NAMES: dict[str, str] = _WORDS["state_names"]
MARKET_SUFFIXES, MARKET_SUFFIXES_OFFLINE, ACRONYMS = (tuple(_WORDS[k]) for k in ("market_words", "market_words_offline", "acronyms"))
#: What counts as white space at the ends of a text: Unicode's, and the separators from 1C to 1F.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_MONTHS = {name[:n]: k for k, name in enumerate("january february march april may june july august september october november december".split(), 1) for n in (3, len(name))} | {"sept": 9}
_TOKEN = r"(\d{1,4}|[A-Za-z]{3,9})(?:(?<=\d)(?:st|nd|rd|th))?"
_FREE = rf"^(?:[A-Za-z]{{3,9}},\s*)?{_TOKEN}\.?(?:\s*[/.-]\s*|[ ,]+){_TOKEN}\.?,?(?:(?:\s*[/.-]\s*|[ ,]+)(\d{{1,4}}))?(?:(?:T|,?\s+)(\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))?\s*([AaPp][Mm])?)?$"


def bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, with x computed once though f uses it often."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def strip(x: Column) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.btrim(x.cast("string"), F.lit(WHITE_SPACE))


def lower_strip(x: Column) -> Column:
    """Lower case without outer white space; an empty string gives null, a blank one stays empty."""
    return F.when(x.cast("string") != "", F.lower(strip(x)))


def blank_to_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def collapse(x: Column) -> Column:
    """Lower case with runs of white space as one space; null as empty."""
    return F.lower(F.regexp_replace(strip(F.coalesce(x, F.lit(""))), r"(?U)\s+", " "))


def truthy(x: Column) -> Column:
    """Neither null nor an empty string."""
    return x.isNotNull() & (x.cast("string") != "")


def first_truthy(*xs: Column) -> Column:
    """The first value that is neither null, empty nor a numeric zero; else the last as it is.

    Strings count as empty only when they have no characters: "0" is a value.
    """
    *head, last = xs
    return F.coalesce(*(F.when(truthy(x), x) for x in head), last)


def first_truthy_number(*xs: Column) -> Column:
    *head, last = xs
    return F.coalesce(*(F.when(x != 0, x) for x in head), last)


def parse_date(x: Column, today: Column | None = None) -> Column:
    """A timestamp from a date string.

    YYYY-MM-DD at the start (what follows is dropped) or YYYYMMDD; else two or three parts, day first, of numbers and
    month names in the orders that people use, with an ordinal's ending, a day's name in front or a time behind:
    9/7/26, 09-Jul-2026, July 9, 2026, 9th Jul 2026 06:30 PM. With numbers only, the second is the month unless it
    can't be one; a first part over 31 is the year, and then the last is the month if it can be one. Years of two
    digits are those within fifty years of today, and what is missing (Jul 2026, 9 Jul) is today's, the day at most
    the month's last. Anything else is null.
    """
    now = F.current_date() if today is None else F.to_date(today)
    months = F.create_map(*(F.lit(v) for kv in _MONTHS.items() for v in kv))

    def free(g: Column) -> Column:
        """From the parts a, b, c of the date and hour, minute, second, half of the day."""
        part = [F.get(g, F.lit(k)) for k in range(7)]
        first, second = (months[F.lower(part[k])] for k in (0, 1))
        read = {"a": F.coalesce(first, part[0].try_cast("int")), "b": F.coalesce(second, part[1].try_cast("int")), "c": part[2].try_cast("int"), "first": first.isNotNull(), "second": second.isNotNull()}
        return F.when(F.size(g) == 7, bound(F.struct(*(x.alias(n) for n, x in read.items())), lambda v: F.when(~(v["first"] & v["second"]) & v["a"].isNotNull() & v["b"].isNotNull(), bound(order(part, v), lambda o: date(part, v, o)))))

    def order(part: list[Column], v: Column) -> Column:
        a, b, c = v["a"], v["b"], v["c"]
        y, m, d = F.lit("y"), F.lit("m"), F.lit("d")
        three = (
            F.when(v["first"], F.when(b > 31, F.array(m, y, d)).otherwise(F.array(m, d, y)))
            .when(v["second"], F.when(a > 31, F.array(y, m, d)).otherwise(F.array(d, m, y)))
            .when((a > 31) | (F.length(part[0]) > 2), F.when(c <= 12, F.array(y, d, m)).otherwise(F.array(y, m, d)))
            .when((a > 12) | (b <= 12), F.array(d, m, y))
            .otherwise(F.array(m, d, y))
        )
        two = (
            F.when(v["first"], F.when(b > 31, F.array(m, y)).otherwise(F.array(m, d)))
            .when(v["second"], F.when(a > 31, F.array(y, m)).otherwise(F.array(d, m)))
            .when(a > 31, F.array(y, m))
            .when(b > 31, F.array(m, y))
            .when(b <= 12, F.array(d, m))
            .otherwise(F.array(m, d))
        )
        return F.when(part[2] == "", two).otherwise(three)

    def date(part: list[Column], v: Column, order: Column) -> Column:
        def of(kind: str) -> Column:
            at = F.array_position(order, kind)
            return F.when(at == 1, v["a"]).when(at == 2, v["b"]).when(at == 3, v["c"])

        short = F.length(F.get(F.array(*part[:3]), (F.array_position(order, "y") - 1).cast("int"))) <= 2
        near = F.year(now) - F.year(now) % 100 + of("y")
        year = F.when(short, F.when(near >= F.year(now) + 50, near - 100).when(near < F.year(now) - 50, near + 100).otherwise(near)).otherwise(F.coalesce(of("y"), F.year(now)))
        month = of("m")
        last = F.dayofmonth(F.last_day(F.format_string("%04d-%02d-01", year, month).try_cast("date")))
        day = F.coalesce(of("d"), F.least(F.dayofmonth(now), last))
        hour = part[3].try_cast("int")
        hour = F.when(part[6] == "", hour).when((hour < 1) | (hour > 12), None).otherwise(hour % 12 + F.when(F.lower(part[6]) == "pm", 12).otherwise(0))
        time = F.when(part[3] == "", F.lit("")).otherwise(F.format_string(" %02d:%s:%s", hour, part[4], F.when(part[5] == "", F.lit("00")).otherwise(part[5])))
        return F.concat(F.format_string("%04d-%02d-%02d", year, month, day), time)

    def text(s: Column) -> Column:
        return (
            F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(s, 1, 10))
            .when(s.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2)))
            .when(s.rlike(r"^\d\d/(0\d|1[0-2])/\d{4}$"), F.concat_ws("-", F.substring(s, 7, 4), F.substring(s, 4, 2), F.substring(s, 1, 2)))  # the commonest
            .otherwise(bound(F.split(F.regexp_replace(s, _FREE, "$1|$2|$3|$4|$5|$6|$7"), "[|]"), free))
        )

    return bound(strip(x), text).try_cast("timestamp")


def is_future(x: Column, now: Column) -> Column:
    """Later than now by day; null is not in the future."""
    return F.coalesce(F.to_date(x) > F.to_date(now), F.lit(False))


def swap_day_month(x: Column) -> Column:
    """The date with day and month exchanged where the day can be a month."""
    return F.when(F.dayofmonth(x) <= 12, F.make_date(F.year(x), F.dayofmonth(x), F.month(x))).otherwise(F.to_date(x))


def to_price(x: Column, strict: bool = True) -> Column:
    """A number from a price such as 'Rs 5500 / Quintal': what stands before the first slash, digits, dot and minus only.

    With strict, a currency mark's dot ('Rs. 5500') is not part of the number;
    without, it is (0.55).
    """
    head = F.translate(F.split_part(x.cast("string"), F.lit("/"), F.lit(1)), "०१२३४५६७८९", "0123456789")
    return F.regexp_replace(head, r"(?i)rs\.|[^0-9.\-]" if strict else r"[^0-9.\-]", "").try_cast("double")


def lenient_number(x: Column) -> Column:
    return blank_to_null(x).try_cast("double")


def number_or_text(x: Column) -> Column:
    """A whole number's plain form, any other text as it is."""
    return F.coalesce(strip(x).try_cast("bigint").cast("string"), x.cast("string"))


def canonical_state(x: Column) -> Column:
    s = lower_strip(x)
    return F.coalesce(F.create_map(*(F.lit(v) for kv in STATE_NAMES.items() for v in kv))[s], s)


def without_suffix(x: Column, suffixes: tuple[str, ...] = MARKET_SUFFIXES) -> Column:
    """The name without market words, wherever they end a word."""
    return F.trim(F.regexp_replace(x, r"\s*(" + "|".join(suffixes) + r")\b", ""))


def title_case(x: Column) -> Column:
    """Words capitalised, known acronyms in capitals, trailing punctuation kept."""
    words = F.split(F.regexp_replace(F.trim(x), r"\s+", " "), " ")

    def one(w: Column) -> Column:
        core = F.regexp_replace(w, r"[.,;:()/]+$", "")
        tail = F.substr(w, F.length(core) + 1)
        head = F.concat(F.upper(F.substring(core, 1, 1)), F.lower(F.substr(core, F.lit(2))))
        return F.concat(F.when(F.upper(core).isin(*ACRONYMS), F.upper(core)).otherwise(head), tail)

    return F.array_join(F.transform(words, one), " ")


def market_names(x: Column) -> Column:
    """A struct (name, aliases) from names split by slashes: the first with APMC, else the first, is the name."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(x, r"[\n\r]", " "), "/"), lambda p: F.trim(p)), lambda p: p != "")
    tokens = F.transform(parts, title_case)
    apmc = F.filter(tokens, lambda t: t.rlike(r"(?i)\bAPMC\b"))
    others = F.filter(tokens, lambda t: ~t.rlike(r"(?i)\bAPMC\b"))
    name = F.coalesce(F.get(apmc, 0), F.get(tokens, 0), F.lit(""))
    return F.struct(name.alias("name"), F.array_except(F.array_distinct(F.concat(others, apmc)), F.array(name)).alias("aliases"))


def alias_list(names: Column, *base: Column) -> Column:
    """Sorted distinct lower-case names from a comma list and base names."""
    parts = F.split(F.coalesce(names, F.lit("")), ",")
    every = F.transform(F.concat(parts, F.array(*(F.coalesce(b, F.lit("")) for b in base))), lambda p: F.lower(F.trim(p)))
    return F.array_sort(F.array_distinct(F.filter(every, lambda p: p != "")))


def feed_date(x: Column, today: Column) -> Column:
    """dd/MM/yyyy from an ISO date, one in that form as it is, today for null."""
    return F.when(x.isNull(), F.date_format(today, "dd/MM/yyyy")).when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.date_format(F.try_to_timestamp(x, F.lit("yyyy-MM-dd")), "dd/MM/yyyy")).otherwise(x)


def epoch_millis(x: Column, fallback: Column) -> Column:
    """Milliseconds from a number, digits, an ISO or a day-first date; else fallback."""
    s = strip(x)
    day = F.coalesce(F.try_to_timestamp(s, F.lit("yyyy-MM-dd")), F.try_to_timestamp(s, F.lit("dd/MM/yyyy")))
    return F.coalesce(F.when(s.rlike(r"^\d+$"), s.try_cast("bigint")), F.unix_millis(day), fallback)


def date_key(x: Column) -> Column:
    return F.date_format(x, "yyyy-MM-dd")


def duration_text(seconds: Column) -> Column:
    """N/A, 42.3s or 2m 5.5s."""
    return (
        F.when(seconds.isNull(), F.lit("N/A"))
        .when(seconds < 60, F.format_string("%.1fs", seconds))
        .otherwise(F.format_string("%dm %.1fs", F.floor(seconds / 60), seconds - F.floor(seconds / 60) * 60))
    )


def percent_text(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.when(whole == 0, F.lit("N/A")).otherwise(F.format_string(f"%.{digits}f%%", F.lit(100.0) * part / F.nullif(whole, F.lit(0))))


def has_non_ascii(x: Column) -> Column:
    return x.rlike(r"[^\x00-\x7F]")


def number_text(x: Column) -> Column:
    """A number with up to six significant digits and no trailing zeros, with an exponent below 0.0001 and from a million up."""
    x = x.cast("double")

    def halfway(seven: Column) -> Column:
        """Six digits where the shortest form has seven and ends in 5: what the binary number is nearer to, else the even digit."""
        exponent = F.substring_index(seven, "e", -1).cast("int")
        six = F.replace(F.substring(F.ltrim(seven, F.lit("-")), 1, 7), F.lit("."), F.lit("")).cast("int")
        scale = F.pow(F.lit(10.0), F.greatest(6 - exponent, F.lit(0)))
        # the error of |x| * scale, by halves of 26 bits (Dekker)
        size = F.abs(x)
        half = lambda v: v * 134217729.0 - (v * 134217729.0 - v)
        xh, ch = half(size), half(scale)
        xl, cl, product = size - xh, scale - ch, size * scale
        error = ((xh * ch - product) + xh * cl + xl * ch) + xl * cl
        rest = F.when(exponent > 6, F.lit(0.0)).otherwise((six.cast("double") * 10 + 5 - product) - error)
        up = (rest < 0) | ((rest == 0) & (six % 2 == 1))
        kept = six + up.cast("int")
        full = kept == 1_000_000
        digits = F.when(full, F.lit("100000")).otherwise(kept.cast("string"))
        sign = F.when(x < 0, "-").otherwise("")
        return F.concat(sign, F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 5), F.lit("e"), (exponent + full.cast("int")).cast("string"))

    def text(s: Column) -> Column:
        """From the form d.ddddde+dd."""
        exponent = F.substring_index(s, "e", -1).cast("int")
        digits = F.regexp_replace(F.regexp_replace(F.substring_index(s, "e", 1), r"0+$", ""), r"\.$", "")
        plain = F.regexp_replace(F.regexp_replace(F.format_string("%.9f", s.cast("double")), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
        scientific = F.concat(digits, F.when(exponent < 0, "e-").otherwise("e+"), F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")))
        return F.when((exponent < -4) | (exponent > 5), scientific).otherwise(plain)

    six = bound(F.format_string("%.6e", x), lambda s: F.when(s.contains("5e") & (s.cast("double") == x), halfway(s)).otherwise(F.format_string("%.5e", x)))
    return F.when(x == 0, F.lit("0")).when(F.isnan(x), F.lit("nan")).when(F.abs(x) == float("inf"), F.when(x > 0, "inf").otherwise("-inf")).otherwise(bound(six, text))


def composite_key(*xs: Column, sep: str = "||") -> Column:
    """Parts joined by sep, null as empty: unlike concat_ws it keeps positions."""
    return F.concat_ws(sep, *(F.coalesce(x.cast("string"), F.lit("")) for x in xs))


def surrogate_key(*xs: Column) -> Column:
    return F.md5(composite_key(*xs))


def error_text(error: Column, details: Column, size: int) -> Column:
    """Error and details joined by a colon and cut to size."""
    return F.substring(F.concat_ws(": ", F.nullif(error, F.lit("")), F.nullif(details, F.lit(""))), 1, size)


def page_sizes(offset: Column, page: Column, window: Column) -> Column:
    """Rows to ask for at an offset when offset and size together may not exceed window."""
    return F.greatest(F.least(page, window - offset), F.lit(0))


def recipients(x: Column) -> Column:
    """Addresses of a comma or semicolon list."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), "[,;]"), lambda p: F.trim(p)), lambda p: p != "")


def report_subject(day: Column, failed: Column, ok: Column) -> Column:
    status = F.when(failed == 0, "SUCCESS").when(ok > 0, "PARTIAL").otherwise("FAILED")
    return F.concat(F.lit("["), status, F.lit("] Price pipeline "), date_key(day))


def html_escape(x: Column) -> Column:
    for raw, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(raw), F.lit(ref))
    return x
