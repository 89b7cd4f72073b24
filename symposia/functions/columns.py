"""Column functions: text keys, identifiers and lenient coercions. All stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from symposia.rules import vocabulary as V


def strip(c: Column) -> Column:
    """White space (every kind of it) removed from both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    stripped = strip(c)
    return F.when(stripped != "", stripped)


def normalize_text(c: Column) -> Column:
    """Lower case, trimmed, white space collapsed."""
    return strip(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def clean_text(c: Column) -> Column:
    """Line ends to blanks, ``**`` dropped, white space collapsed."""
    return strip(F.regexp_replace(F.replace(c, F.lit("**"), F.lit("")), r"(?U)\s+", " "))


#: Full-width forms and the letters, digits and blanks they stand for, as compatibility normalisation folds them.
WIDE, PLAIN = "".join(chr(0xFF01 + k) for k in range(94)) + "\u3000\u00a0²³¹", "".join(chr(0x21 + k) for k in range(94)) + "  231"
LIGATURES = (("ﬁ", "fi"), ("ﬂ", "fl"), ("…", "..."), ("™", "TM"), ("½", "1⁄2"))


def compatible(c: Column) -> Column:
    """Full-width forms, ligatures and superscripts as plain characters."""
    c = F.translate(c, WIDE, PLAIN)
    for a, b in LIGATURES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def match_key(c: Column) -> Column:
    """Lower-case letters and digits with single blanks: the key on which labels are the same."""
    return F.trim(F.regexp_replace(F.lower(compatible(c)), "[^a-z0-9]+", " "))


def label_key(c: Column) -> Column:
    """Lower case, punctuation to blanks but for ``: / . -``, dashes alike: the key of the canonical linker."""
    dashes = F.regexp_replace(F.lower(strip(compatible(c))), "[–—−]", "-")
    return F.trim(F.regexp_replace(F.regexp_replace(dashes, r"(?U)[^\w\s:/.-]+", " "), r"(?U)\s+", " "))


def aliased(c: Column, table: dict[str, str]) -> Column:
    """The table's value for ``c``, or ``c`` itself."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def mapped(c: Column, table: dict[str, str]) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


def match_label(c: Column) -> Column:
    return aliased(label_key(c), V.MATCH_ALIASES)


def is_acronym(c: Column) -> Column:
    return c.rlike("^[A-Z0-9_-]{2,}$") & c.rlike("[A-Z]") & F.regexp_replace(c, "[-_]", "").rlike("^[A-Z0-9]+$")


def normalize_label(c: Column) -> Column:
    """Known aliases to their canonical label; all-lower labels to title case with acronyms kept; others as typed."""
    cleaned = clean_text(c)
    alias = mapped(match_key(cleaned), V.LABEL_ALIASES)
    acronyms = F.array(*[F.lit(a) for a in V.ACRONYMS])
    words = F.transform(F.split(cleaned, " "), lambda w: F.when(F.array_contains(acronyms, F.upper(w)), F.upper(w)).otherwise(F.initcap(w)))
    titled = F.array_join(words, " ")
    return F.coalesce(alias, F.when(F.lower(cleaned) == cleaned, titled).otherwise(cleaned))


def local_name(c: Column) -> Column:
    """The part after the last ``#``, else after the last ``/``."""
    return F.when(c.contains("#"), F.substring_index(c, "#", -1)).otherwise(F.substring_index(c, "/", -1))


def entity_type(c: Column) -> Column:
    """Type without prefix, in camel case, spelling variants of the known types folded onto them."""
    plain = F.regexp_replace(strip(c), r"^.*[:#/]", "")
    key = F.regexp_replace(F.lower(plain), "[^a-z0-9]", "")
    known = {t.lower(): t for t in (*V.TYPE_CLASSES, "Entity", "PersonalData", "Organisation")} | {"organization": "Organisation"}
    titled = F.regexp_replace(F.initcap(F.regexp_replace(plain, "[_-]+", " ")), " ", "")
    return F.when(key == "", F.lit("Entity")).otherwise(F.coalesce(mapped(key, known), titled, F.lit("Entity")))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def short_hash(c: Column, n: int = 16) -> Column:
    """First ``n`` hexadecimal characters of SHA-256."""
    return F.substring(F.sha2(c, 256), 1, n)


def md5_hash(c: Column, n: int = 16) -> Column:
    return F.substring(F.md5(c), 1, n)


def canonical_uri(key: Column, kind: Column, ontology: Column, base: str = V.KG) -> Column:
    """``<base><type>_<slug>_<10 of sha1>`` of key, type and ontology class."""
    name = F.regexp_replace(F.regexp_replace(F.lower(key), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.concat(F.lit(base), F.lower(kind), F.lit("_"), name, F.lit("_"), F.substring(F.sha1(F.concat_ws("|", key, kind, F.coalesce(ontology, F.lit("")))), 1, 10))


def relation_uri(discourse: Column, s: Column, p: Column, o: Column) -> Column:
    none = F.lit("None")
    return F.concat(F.lit("rel_"), short_hash(F.concat_ws("|", F.coalesce(discourse, none), F.coalesce(s, none), F.coalesce(p, none), F.coalesce(o, none))))


def expand_curie(c: Column, prefixes: dict[str, str]) -> Column:
    """Prefix replaced by its namespace where it is known; anything else unchanged."""
    space = mapped(F.substring_index(c, ":", 1), prefixes)
    return F.when(c.contains(":") & space.isNotNull(), F.concat(space, F.expr("''"), F.regexp_replace(c, "^[^:]*:", ""))).otherwise(c)


def normalize_url(c: Column) -> Column:
    """Scheme and host in lower case, no fragment, no ``utm_`` parameters, no slash at the end; other texts trimmed."""
    text = F.regexp_replace(strip(c), "#.*$", "")
    host = F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1)
    rest = F.substr(text, F.length(host) + 1)
    path = F.regexp_replace(F.regexp_replace(rest, r"\?.*$", ""), "/+$", "")
    query = F.array_join(F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda q: (q != "") & ~F.lower(q).startswith("utm_")), "&")
    return F.when(host != "", F.concat(F.lower(host), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))).otherwise(text)


def external_id(c: Column) -> Column:
    """Knowledge-base numbers and DOIs in one form, web addresses normalised, other identifiers in lower case."""
    text = strip(c)
    q = F.regexp_extract(text, r"(?i)(?:^|/|:)(q\d+)$", 1)
    doi = F.regexp_extract(F.lower(text), r"(?:^doi:\s*|doi\.org/|^)(10\..+)$", 1)
    plain = F.when(text.rlike("(?i)^https?://"), normalize_url(text)).otherwise(F.lower(text))
    return F.when(q != "", F.concat(F.lit("wikidata:"), F.upper(q))).when(doi != "", F.concat(F.lit("doi:"), doi)).when(plain != "", plain)


def minted_uri(kind: Column, key: Column, base: str = V.KG) -> Column:
    """``<base without #>/entity/<type>/<key>-<8 of sha1>`` of type and key."""
    return F.concat(F.lit(base.rstrip("#") + "/entity/"), slug(kind), F.lit("/"), slug(key), F.lit("-"), F.substring(F.sha1(F.concat_ws("|", kind, key)), 1, 8))


def sanitized(c: Column) -> Column:
    """Everything but letters, digits and underscores to underscores, case kept; ``Resource`` for nothing."""
    out = F.regexp_replace(F.regexp_replace(strip(c), r"[^A-Za-z0-9_]+", "_"), "^_+|_+$", "")
    return F.when(F.coalesce(out, F.lit("")) == "", F.lit("Resource")).otherwise(out)


def camel_case(c: Column) -> Column:
    """Words joined, the first in lower case, the others with a capital."""
    joined = F.replace(F.initcap(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", " ")), F.lit(" "), F.lit(""))
    return F.concat(F.lower(F.substring(joined, 1, 1)), F.substr(joined, F.lit(2)))


def uri_safe(c: Column) -> Column:
    """The local part of a uri: blanks to underscores, what may not stand in one percent-encoded (``url_encode`` writes a blank as ``+``)."""
    return F.replace(F.replace(F.replace(F.replace(F.url_encode(F.regexp_replace(strip(c), r"(?U)\s+", "_")), F.lit("%3A"), F.lit(":")), F.lit("%40"), F.lit("@")), F.lit("%2F"), F.lit("/")), F.lit("%7E"), F.lit("~"))


def is_iri(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^(https?://|urn:)[^\s<>\"{}|\\^`]+$"), F.lit(False))


def is_iso_date(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), F.lit(False))


def single_value(c: Column) -> Column:
    """Of a list written as ``a; b, c`` the least part in lower case."""
    return F.array_min(F.filter(F.transform(F.split(F.lower(c), "[;,]"), lambda x: F.trim(x)), lambda x: x != ""))


def rdf_node(c: Column) -> Column:
    """``<iri>`` for an absolute identifier, else a quoted literal."""
    return F.when(is_iri(c), F.concat(F.lit("<"), c, F.lit(">"))).otherwise(F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))


def rating_concept(c: Column) -> Column:
    """The concept of a rating word or of a number from 1 to 5."""
    key = F.regexp_replace(F.lower(strip(c.cast("string"))), "[^a-z0-9]", "")
    return mapped(key, V.RATINGS)


def coerce_int(c: Column) -> Column:
    """The first whole number in a text; null where there is none."""
    return F.nullif(F.regexp_extract(c.cast("string"), r"-?\d+", 0), F.lit("")).try_cast("bigint")


def coerce_nonneg(c: Column) -> Column:
    n = coerce_int(c)
    return F.when(n >= 0, n)


def coerce_bool(c: Column) -> Column:
    low = F.lower(strip(c.cast("string")))
    return F.when(low.isin("true", "1", "yes", "y"), F.lit(True)).when(low.isin("false", "0", "no", "n"), F.lit(False))


def coerce_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"))


def clamp(c: Column) -> Column:
    """Confidence as a number from 0 to 1; what is no number counts as 0."""
    n = F.coalesce(c.try_cast("double"), F.lit(0.0))
    return F.when(F.isnan(n), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), n)))


def origin_key(field: Column, discourse: Column) -> Column:
    return F.when((F.coalesce(field, F.lit("")) != "") & (F.coalesce(discourse, F.lit("")) != ""), F.concat_ws("|", field, discourse)).otherwise(discourse)


def evidence_text(c: Column, fallback: Column, most: int = 500) -> Column:
    return F.substring(F.coalesce(blank_to_null(c), fallback), 1, most)


def token_count(c: Column) -> Column:
    """Words times 1.3, rounded down, at least one; the defined stand-in for a tokenizer's count."""
    words = F.size(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != ""))
    return F.greatest(F.lit(1), F.floor(words * V.TOKENS_A_WORD)).cast("int")


def question_kind(c: Column) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    out = None
    for kind, words in V.QUESTION_KINDS:
        hit = reduce(lambda a, b: a | b, [low.contains(w) for w in words])
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("general")


def type_from_uri(c: Column) -> Column:
    low = F.lower(c)
    out = None
    for kind in ("Expert", "Answer", "Question", "Theme", "Vote", "Document"):
        hit = low.rlike(f"[#/]{kind.lower()}[_/]")
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.when(low.rlike("[#/]discourse[_/]"), "DiscourseUnit").otherwise("Entity")


def label_tokens(c: Column) -> Column:
    """Distinct words of a label's key, without a company's legal form at its end."""
    words = F.filter(F.split(label_key(c), "[ _/:-]+"), lambda w: w != "")
    last = F.try_element_at(words, F.lit(-1))
    return F.array_distinct(F.when(last.isin(*V.COMPANY_SUFFIXES) & (F.size(words) > 1), F.slice(words, 1, F.size(words) - 1)).otherwise(words))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def normalize_predicate(c: Column) -> Column:
    """One of the canonical predicates: by spelling, then by spelling without blanks, else ``relatedTo``."""
    key = F.trim(F.replace(F.regexp_replace(F.lower(strip(c)), r"(?U)[\s-]+", " "), F.lit("_"), F.lit(" ")))
    table = F.create_map(*[F.lit(x) for kv in V.PREDICATE_OF.items() for x in kv])
    return F.coalesce(F.try_element_at(table, key), F.try_element_at(table, F.replace(key, F.lit(" "), F.lit(""))), F.lit(V.DEFAULT_PREDICATE))


def exact_predicate(c: Column) -> Column:
    """The canonical predicate that a text names in any case; null for every other spelling."""
    return mapped(F.lower(strip(c)), {p.lower(): p for p in V.PREDICATE_SPELLINGS})


def vote_bucket(c: Column) -> Column:
    low = F.lower(strip(c))
    return F.when(low.isin(*V.POSITIVE_VOTES), "endorses").when(low.isin(*V.NEGATIVE_VOTES), "disagreesWith").when(low.isin(*V.NEUTRAL_VOTES), "isNeutralOn").otherwise("interactsWith")


def reference(c: Column) -> Column:
    """The whole number a text spells (``7``, `` 7``, ``7.0``, ``+7``, ``007``); null for anything else and for zero."""
    digits = F.regexp_extract(strip(c.cast("string")), r"^([+-]?\d+)(?:\.0*)?$", 1)
    return F.nullif(F.when(digits != "", digits).try_cast("bigint"), F.lit(0).cast("bigint"))
