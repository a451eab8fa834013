"""Owner names and addresses as column expressions: typing, normal forms, keys and matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that tell an owner's type, in order of precedence (the first type that matches wins).
TYPE_WORDS = (
    ("government", r"STATE OF MARYLAND|MARYLAND DEPT|DEPARTMENT OF|COUNTY COMMISSIONERS|BOARD OF (COUNTY )?COMMISSIONERS|BOARD OF EDUCATION|COUNTY OF|CITY OF|TOWN OF|MUNICIPAL|UNITED STATES|U ?S ?A|DEPT OF NATURAL RESOURCES|DNR|MARYLAND ENVIRONMENTAL TRUST|SANITARY COMM|HOUSING AUTHORITY"),
    ("religious_nonprofit", r"CHURCH|PARISH|CONGREGATION|DIOCESE|ARCHDIOCESE|MINISTRIES|MINISTRY|CEMETERY|SYNAGOGUE|TEMPLE|MOSQUE|FOUNDATION|CONSERVANCY|LAND TRUST|BRETHREN|MENNONITE|LUTHERAN|METHODIST|BAPTIST|CATHOLIC|PRESBYTERIAN|FRIENDS MEETING|SOCIETY OF"),
    ("trust", r"TRUST(EE|EES)?|TRS?|REVOCABLE|IRREVOCABLE|LIVING TR|FAMILY TR|REV TR|TR AGREEMENT|U/A|UAD|ESTATE OF|EST OF|LIFE ESTATE"),
    ("llc", r"LLC|LLLP|LLP|PLLC"),
    ("corporation", r"INC|INCORPORATED|CORP|CORPORATION|CO|COMPANY|LTD|LIMITED|LP|PARTNERSHIP|PARTNERS|ASSOCIATES|ASSOC|ASSN|ASSOCIATION|ENTERPRISES|HOLDINGS|PROPERTIES|INVESTMENTS|DEVELOPMENT|DEVELOPERS|GROUP|VENTURES|FARMS? INC|REALTY"),
)
# Words that do not tell owners apart.
NOISE = r"ET ?AL|ETALS?|ET ?UX|ET ?VIR|AND WIFE|AND HUSBAND|H/W|W/H|T/E|TE|JT|JTWROS|TRUSTEES?|TRS?|CO-?TRUSTEES?|LIFE ESTATE|JR|SR|II|III|IV|MRS?|MS|DR"
# Street words and their short forms.
STREET = (("ROAD", "RD"), ("STREET", "ST"), ("DRIVE", "DR"), ("LANE", "LN"), ("AVENUE", "AVE"), ("COURT", "CT"), ("PIKE", "PK"), ("P ?O BOX", "POBOX"))


def _sub(col: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(col, "(?U)" + pattern, by)


def _squeezed(col: Column) -> Column:
    return F.trim(_sub(col, r"\s+", " "))


def owner_type(name: Column | str) -> Column:
    """government, religious_nonprofit, trust, llc, corporation or individual; null or blank is unknown."""
    text = _squeezed(F.translate(F.upper(F.col(name) if isinstance(name, str) else name), ",.", " "))
    kinds = [F.when(text.rlike(rf"(?U)\b({words})\b"), kind) for kind, words in TYPE_WORDS]
    return F.when(text.isNull() | (text == ""), "unknown").otherwise(F.coalesce(*kinds, F.lit("individual")))


def normal_name(name: Column | str) -> Column:
    """Upper case without punctuation, relationship words or AND; null is empty."""
    text = F.coalesce(F.upper(F.col(name) if isinstance(name, str) else name), F.lit(""))
    text = _sub(F.replace(text, F.lit("&"), F.lit(" AND ")), r"[^\w\s/]", " ")
    return _squeezed(_sub(_sub(text, rf"\b({NOISE})\b", " "), r"\bAND\b", " "))


def name_tokens(name: Column | str) -> Column:
    return F.array_distinct(F.filter(F.split(normal_name(name), " "), lambda t: F.char_length(t) > 1))


def joined_address(*parts: str) -> Column:
    """Non-blank parts, trimmed, one space between."""
    clean = [F.trim(F.col(p).cast("string")) for p in parts]
    return F.concat_ws(" ", *[F.when((c != "") & (F.lower(c) != "nan"), c) for c in clean])


def normal_address(address: Column | str) -> Column:
    """Upper case, no punctuation, short street words, five-digit ZIP codes; null is empty."""
    col = F.col(address) if isinstance(address, str) else address
    text = F.when(F.lower(F.trim(col)).isin("nan", ""), "").otherwise(F.coalesce(F.upper(col), F.lit("")))
    text = _sub(text, r"[^\w\s]", " ")
    text = _squeezed(reduce(lambda c, w: _sub(c, rf"\b({w[0]})\b", w[1]), STREET, text))
    return _sub(text, r"\b(\d{5})\s?\d{4}\b", "$1")


def owner_key(name: Column | str, address: Column | str) -> Column:
    return F.concat(normal_name(name), F.lit("|"), normal_address(address))


def tokens_match(a: Column, b: Column, least: float = 0.6) -> Column:
    """Jaccard similarity of ``least`` or more, or one non-empty set inside the other."""
    common, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    inside = (F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0)
    return (F.size(a) > 0) & (F.size(b) > 0) & ((common / F.greatest(union, F.lit(1)) >= least) | ((common > 0) & inside))


def owners_match(tokens_a: Column, tokens_b: Column, address_a: Column, address_b: Column, least: float = 0.6) -> Column:
    """The same owner by name tokens, or by equal normal addresses that are not empty."""
    same_address = (address_a == address_b) & (address_a != "")
    return F.coalesce(tokens_match(tokens_a, tokens_b, least), F.lit(False)) | F.coalesce(same_address, F.lit(False))
