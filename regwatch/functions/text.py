"""Names, addresses, postcodes, links and dates as Column functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of company names, ratings and links that results must agree on.
LEGAL_FORMS = ("LIMITED", "LTD", "LLP", "PLC", "CIC", "LP", "UNLIMITED")
NAME_NOISE = ("and", "the", "ltd", "limited", "plc", "llp", "co", "company", "uk")
RATED = ("0", "1", "2", "3", "4", "5", "Pass", "Pass and Eat Safe", "Improvement Required")
SMALL_WORDS = ("and", "the", "of", "on", "in", "at", "to", "by", "for", "a", "an")
COMPANY_LINK = "https://find-and-update.company-information.service.gov.uk/company/"
ENTITY_LINK = "https://ratings.food.gov.uk/business/"
MAP_LINK = "https://www.google.com/maps/search/?api=1&query="
PREMISES = {
    "Restaurant/Cafe/Canteen": "Cafe / restaurant",
    "Pub/bar/nightclub": "Pub / bar",
    "Hotel/bed & breakfast/guest house": "Hotel / B&B",
    "Other catering premises": "Other catering",
    "Takeaway/sandwich shop": "Takeaway",
    "Retailers - other": "Food shop",
    "Retailers - supermarkets/hypermarkets": "Supermarket",
    "Mobile caterer": "Mobile caterer",
}
STREET_WORDS = (
    "road", "street", "lane", "avenue", "way", "drive", "close", "place", "row", "court", "square", "parade", "terrace", "crescent", "gardens", "walk", "mews",
    "hill", "rise", "grove", "bank", "wharf", "quay", "unit", "floor", "premises", "estate", "park ", "centre", "arcade", "precinct", "retail", "industrial", "business",
)
#: Counties and countries that stand in addresses as a line of their own, in lower case; a dimension that callers may replace.
COUNTIES = (
    "avon", "bedfordshire", "berkshire", "buckinghamshire", "cambridgeshire", "cheshire", "cleveland", "cornwall", "cumbria", "derbyshire", "devon",
    "dorset", "durham", "co durham", "county durham", "east sussex", "essex", "gloucestershire", "greater manchester", "hampshire", "herefordshire",
    "hertfordshire", "humberside", "isle of wight", "kent", "lancashire", "leicestershire", "lincolnshire", "merseyside", "middlesex", "norfolk",
    "north humberside", "north yorkshire", "northamptonshire", "northumberland", "nottinghamshire", "oxfordshire", "rutland", "shropshire",
    "somerset", "south humberside", "south yorkshire", "staffordshire", "suffolk", "surrey", "tyne and wear", "tyne & wear", "warwickshire",
    "west midlands", "west sussex", "west yorkshire", "wiltshire", "worcestershire", "scotland", "wales", "england", "united kingdom", "uk", "antrim",
    "armagh", "down", "co down", "county down", "fermanagh", "londonderry", "derry", "tyrone", "northern ireland", "ayrshire", "banffshire",
    "berwickshire", "caithness", "dumfriesshire", "dunbartonshire", "inverness-shire", "kincardineshire", "kirkcudbrightshire", "lanarkshire",
    "morayshire", "peeblesshire", "perthshire", "renfrewshire", "ross-shire", "roxburghshire", "selkirkshire", "stirlingshire", "sutherland",
    "wigtownshire", "clwyd", "dyfed", "gwent", "glamorgan", "mid glamorgan", "south glamorgan", "west glamorgan",
)
STREET_LENGTH = 42
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćĉċčďēĕėęěĝğġģĥĩīĭįĵķĺļľńņňōŏőŕŗřśŝşšţťũūŭůűųŵŷźżž"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def postcode_district(c: Column) -> Column:
    """Outward part of a full postcode, or a bare outward code; null for anything else."""
    p = F.replace(F.upper(F.trim(c)), F.lit(" "), F.lit(""))
    full = F.when(p.rlike("^[A-Z].*[0-9][A-Z]{2}$"), F.substring(p, F.lit(1), F.length(p) - 3))
    return F.when(F.length(p).between(5, 7), full).when(p.rlike("^[A-Z]{1,2}[0-9][A-Z0-9]?$"), p)


def postcode_area(c: Column) -> Column:
    return blank_to_null(F.regexp_extract(postcode_district(c), "^[A-Z]+", 0))


def company_name_norm(c: Column) -> Column:
    """Upper-case words of a company name without its legal forms at the end; null is empty."""
    words = F.trim(F.regexp_replace(F.regexp_replace(F.replace(F.upper(text(c)), F.lit("&"), F.lit(" AND ")), "[^A-Z0-9 ]", " "), " +", " "))
    return F.trim(F.regexp_replace(words, rf"( ?\b({'|'.join(LEGAL_FORMS)}))+$", ""))


def squash(c: Column) -> Column:
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]", "")


def overlap_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(text(c)), r"[^\p{L}\p{N}]", "")


def squash_name(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.replace(F.lower(text(c)), F.lit("&"), F.lit(" and ")), rf"\b({'|'.join(NAME_NOISE)})\b", " "), "[^a-z0-9]", "")


def address_key(line1: Column, postcode: Column) -> Column:
    """'LINE|POSTCODE' in capitals, or null if either is blank."""
    a, b = F.upper(F.trim(line1)), F.upper(F.trim(postcode))
    return F.when((a != "") & (b != ""), F.concat_ws("|", a, b))


def address_density_key(line1: Column, postcode: Column) -> Column:
    return F.concat_ws("|", F.upper(F.trim(text(line1))), F.upper(F.trim(text(postcode))))


def operator_prefix(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("@")), blank_to_null(F.trim(F.substring_index(c, "@", 1))))


def is_multi_word(c: Column) -> Column:
    return F.contains(company_name_norm(c), F.lit(" "))


def join_address(*lines: Column) -> Column:
    return F.concat_ws(", ", *(blank_to_null(x) for x in lines))


def postcode_completeness(c: Column) -> Column:
    n = F.length(F.replace(text(c), F.lit(" "), F.lit("")))
    return F.when(n == 0, "none").when(n < 5, "district_only").otherwise("full")


def address_completeness(lines: list[Column], postcode: Column) -> Column:
    """The postcode dominates: a short one makes any address district_only."""
    code, some = postcode_completeness(postcode), join_address(*lines) != ""
    return F.when(code == "none", "no_address").when(code == "district_only", "district_only").when(some, "full").otherwise("postcode_only")


def rating_status(c: Column) -> Column:
    tidy = F.lower(F.replace(c, F.lit(" "), F.lit("")))
    return F.when(c.isin(*RATED), "Rated").when(tidy == "awaitinginspection", "Awaiting Inspection").when(tidy == "awaitingpublication", "Awaiting Publication").when(tidy == "exempt", "Exempt").otherwise("Unknown")


def iso_date(c: Column) -> Column:
    """A date from strictly YYYY-MM-DD text; anything else is null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def days_since(c: Column, as_of: Column) -> Column:
    return F.datediff(as_of, c)


def _link(prefix: str, c: Column) -> Column:
    return F.when(text(c.cast("string")) != "", F.concat(F.lit(prefix), c.cast("string"))).otherwise("")


def entity_url(c: Column) -> Column:
    return _link(ENTITY_LINK, c)


def company_url(c: Column) -> Column:
    return _link(COMPANY_LINK, c)


def percent_encoded(c: Column) -> Column:
    out = F.url_encode(c)
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def map_url(address: Column, postcode: Column) -> Column:
    query = join_address(address, postcode)
    return F.when(query != "", F.concat(F.lit(MAP_LINK), percent_encoded(query))).otherwise("")


def format_codes(c: Column) -> Column:
    return F.coalesce(F.array_join(F.from_json(c, "array<string>"), ", "), F.lit(""))


def stripped(c: Column) -> Column:
    """Without white space at either end; null is empty."""
    return F.regexp_replace(text(c), r"^\s+|\s+$", "")


def _once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f reads it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def tidy_name(c: Column) -> Column:
    """The name without white space around it, null as empty; in title case where it is all in capitals and longer than
    three characters, small words lower except the first."""

    def titled(c: Column) -> Column:
        pieces = F.transform(F.split(F.lower(c), r"(?<=[^\p{L}])"), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x))))
        words = F.split(F.array_join(pieces, ""), " ")
        small = F.transform(words, lambda w, i: F.when((i > 0) & F.lower(w).isin(*SMALL_WORDS), F.lower(w)).otherwise(w))
        return F.when((F.length(c) > 3) & (c == F.upper(c)) & c.rlike(r"\p{L}"), F.array_join(small, " ")).otherwise(c)

    return _once(stripped(c), titled)


def premises_label(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in PREMISES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, text(c)), c, F.lit(""))


def place_norm(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim(text(c))), "^the ", ""), "[.,]", ""), r"\s+", " "))


def fold_accents(c: Column) -> Column:
    """Lower-case Latin letters without their marks, trimmed of spaces, commas and dots."""
    return F.regexp_replace(F.translate(F.lower(text(c)), ACCENTED, _plain(ACCENTED)), "^[ ,.]+|[ ,.]+$", "")


def _plain(letters: str) -> str:
    """The base letter of each accented letter, by Unicode decomposition; letters without one stay."""
    import unicodedata

    return "".join(unicodedata.normalize("NFKD", c)[0] for c in letters)


def clean_name(c: Column) -> Column:
    """tidy_name, and of two names with a slash between them the first, where it holds the other. Empty parts do not count."""

    def chosen(tidy: Column) -> Column:
        parts = F.filter(F.transform(F.split(tidy, "/"), lambda x: stripped(x)), lambda x: x != "")
        first, second = (lambda p: F.get(p, F.lit(0))), (lambda p: F.get(p, F.lit(1)))
        return _once(parts, lambda p: F.when((F.size(p) == 2) & F.contains(F.lower(first(p)), F.lower(second(p))), first(p)).otherwise(tidy))

    return _once(tidy_name(c), chosen)


def looks_like_street(c: Column) -> Column:
    """A house number in front (12, 12a, but not 12th), or a street word after a space or at the start (so 'row' also meets
    'Rowan')."""
    return F.concat(text(c), F.lit(" ")).rlike(rf"(?i)^\s*\d+[a-z]?\b|(?:^| )(?:{'|'.join(STREET_WORDS)})")


def effective_postcode(bulk: Column, live: Column, order: str = "bulk") -> Column:
    first, second = (bulk, live) if order == "bulk" else (live, bulk)
    return F.coalesce(blank_to_null(first), blank_to_null(second))


def edit_distance_within(a: Column, b: Column, most: int) -> Column:
    return F.levenshtein(a, b, most).between(0, most)


def _literal(c: Column) -> Column:
    """A text as a pattern that matches itself."""
    return F.concat(F.lit("(?i)"), F.regexp_replace(c, r"([\\\\.\[\]{}()*+?^$|-])", r"\\$1"))


def address_parts(name: Column, lines: list[Column], council: Column, postcode: Column, counties: tuple[str, ...] = COUNTIES, longest: int = STREET_LENGTH) -> Column:
    """Struct of name, street, town, postcode from loose address lines.

    The postcode is cut out of every line, in any case. Lines that repeat the name go, as does a line that is the council
    (with or without what it has in brackets), which is remembered, and a county. The rest is read from its end: streets
    are passed over; the first other line is the town, unless it is the first of several, where reading stops. What stands
    after the town goes. Without a town a remembered council is the town. A street longer than allowed keeps its last line.
    """
    shown = stripped(F.regexp_replace(text(council), r"\s*\(.*?\)\s*", ""))
    edges = lambda x, chars: F.regexp_replace(x, f"^[{chars}]+|[{chars}]+$", "")

    def read(k: Column) -> Column:
        """k: title, code, council and shown of a record."""
        facts = F.struct(fold_accents(k["title"]).alias("title"), _literal(k["code"]).alias("code"))
        return _once(facts, lambda f: _once(bare(k, f), lambda rest: _once(split(k, rest), lambda s: done(k, s))))

    def bare(k: Column, f: Column) -> Column:
        """The lines that stay, without the postcode, and each in lower case without commas around it."""
        cut = lambda x: F.when((k["code"] != "") & (x != ""), edges(F.regexp_replace(x, f["code"], F.lit("")), " ,")).otherwise(x)
        kept = F.filter(F.transform(F.array(*(stripped(x) for x in lines)), cut), lambda x: (x != "") & (fold_accents(x) != f["title"]))
        return F.transform(kept, lambda x: F.struct(x.alias("line"), edges(F.lower(x), " ,").alias("low")))

    def split(k: Column, rest: Column) -> Column:
        """Lines that are the council, and the others with whether each is a street."""
        is_council = lambda x: x["low"].isin(k["council"], F.lower(k["shown"]))
        whole = F.transform(F.filter(rest, lambda x: ~is_council(x) & ~x["low"].isin(*counties)), lambda x: tidy_name(x["line"]))
        return F.struct(F.filter(rest, is_council).alias("named"), F.transform(whole, lambda x: F.struct(x.alias("line"), looks_like_street(x).alias("street"))).alias("lines"))

    def done(k: Column, s: Column) -> Column:
        named, size = s["named"], F.size(s["lines"])
        # The last line that is no street.
        last = F.array_max(F.transform(s["lines"], lambda x, i: F.when(~x["street"], i)))
        at = F.when((last > 0) | (size == 1), last)
        remembered = F.when(F.size(named) > 0, F.when(k["shown"] != "", k["shown"]).otherwise(tidy_name(F.get(named, F.size(named) - 1)["line"]))).otherwise("")
        town = F.when(at.isNotNull(), F.get(s["lines"], at)["line"]).otherwise(remembered)
        street = F.transform(F.slice(s["lines"], F.lit(1), F.coalesce(at, size)), lambda x: x["line"])
        joined = lambda x: F.array_join(x, ", ")
        short = _once(street, lambda x: F.when((F.length(joined(x)) > longest) & (F.size(x) > 0), F.element_at(x, -1)).otherwise(joined(x)))
        return F.struct(k["title"].alias("name"), short.alias("street"), town.alias("town"), k["code"].alias("postcode"))

    return _once(F.struct(clean_name(name).alias("title"), stripped(postcode).alias("code"), F.lower(text(council)).alias("council"), shown.alias("shown")), read)


def any_of(c: Column, parts: tuple[str, ...]) -> Column:
    """Whether a text holds one of the parts."""
    return reduce(lambda a, b: a | b, (F.contains(c, F.lit(p)) for p in parts))
