"""Variant spellings of names typed by people (problem 2), as noisy-channel attribution.

Every label is parsed into a node: for a person the family name and the given name it stands for (short forms
resolved where only one name has them, initials kept as such), for an organisation its own name, its kind (council,
institute, ...) and its subject. Records with the same node are one spelling; the number of its records is its
frequency. Each spelling is then attributed to the canonical form of greatest posterior among the spellings whose
name lies within one typing error (found through deletion neighbourhoods, an exact equi-join, never by comparing all
with all): prior = frequency of the canonical form, likelihood = typing errors of every part, short forms, initials,
abbreviated or missing parts. A spelling seen more often than slips of the canonical form can explain keeps to
itself; a slip of a far more frequent name may recur. Attributions are then followed to their ends by the components operator.

Defined results: a null or empty label falls back to the decision's norm_label, and a record without either names
nobody; decisions repeated under one id are one record; labels in which no name is found (punctuation, a title
alone) are linked to nothing; equal posteriors fall to the more frequent, then the smaller spelling.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.llm.components import components
from symposia.llm.cooccurrence import pair_scores
from symposia.runtime import cut, read, salted, spread

#: Given names of English with the short forms that dictionaries of names give for them; further ones are learned.
SHORT_FORMS = {
    "abigail": "abby gail", "albert": "al bert bertie", "alexander": "alex sandy sasha", "alfred": "alf fred freddie", "andrew": "andy drew", "anthony": "tony", "arthur": "art artie", "barbara": "barb babs", "benjamin": "ben benny", "catherine": "cathy kate kitty",
    "charles": "charlie chuck", "charlotte": "lottie charlie", "christopher": "chris kit", "cynthia": "cindy", "daniel": "dan danny", "david": "dave davy", "deborah": "deb debbie", "dorothy": "dot dolly", "edward": "ed eddie ted ned", "eleanor": "ellie nell nora",
    "elizabeth": "liz beth betty eliza", "emily": "em millie", "eugene": "gene", "florence": "flo flossie", "frances": "fran frankie", "francis": "frank", "frederick": "fred freddie", "gabriel": "gabe", "george": "georgie", "gerald": "gerry jerry",
    "gregory": "greg", "harold": "hal harry", "helen": "nell nellie", "henry": "harry hank hal", "isabella": "bella izzy", "jacob": "jake", "james": "jim jimmy jamie", "jennifer": "jen jenny", "jessica": "jess jessie", "john": "jack johnny",
    "jonathan": "jon jonny", "joseph": "joe joey", "joshua": "josh", "judith": "judy", "katherine": "kate kathy kit", "kenneth": "ken kenny", "lawrence": "larry", "leonard": "leo len lenny", "louis": "lou louie", "margaret": "maggie meg peggy",
    "martha": "marty patty", "matthew": "matt", "michael": "mike mick", "nathaniel": "nat nate", "nicholas": "nick", "oliver": "ollie", "pamela": "pam", "patricia": "pat patty tricia", "patrick": "pat paddy", "peter": "pete",
    "philip": "phil pip", "raymond": "ray", "rebecca": "becky", "richard": "dick rick rich", "robert": "bob rob bobby", "ronald": "ron ronnie", "samantha": "sam", "samuel": "sam sammy", "stephen": "steve", "steven": "steve",
    "susan": "sue susie", "theodore": "ted theo", "theresa": "terry tess", "thomas": "tom tommy", "timothy": "tim", "victoria": "vicky tori", "vincent": "vince", "walter": "walt wally", "william": "bill will billy", "zachary": "zach zack",
}
TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "mx", "miss", "sir", "dame", "doctor", "herr", "frau"}
#: Kinds of organisations, the commoner ones first; a word abbreviates the first kind that begins alike and has its letters in order.
KINDS = (
    "university institute institution centre center department laboratory foundation council commission association agency authority office board committee society "
    "college ministry observatory academy bureau division federation group museum network organisation school secretariat service trust union"
).split()
SAME_KIND = {"center": "centre", "institution": "institute"}
LEGAL = {"ltd", "corp", "co", "inc", "gmbh", "llc", "plc", "company", "limited", "corporation", "ag", "sa"}
LINKING = {"for", "f", "of", "the", "and", "on", "in"}

P_TYPO, P_TYPO_MORE, P_INITIAL, P_SHORT, P_NO_KIND, P_LETTERS, P_SELF = 0.02, 0.001, 0.3, 0.5, 0.2, 0.3, 0.001
#: What makes a word a given name, and two given names forms of one; the most of either that are brought to the driver.
GIVEN_RECORDS, GIVEN_PARTNERS = 10, 8
FORM_FAMILIES, FORM_LIFT, FORM_SHARE = 4, 5, 0.25
MOST_GIVEN = 200_000
#: Names of this length may have two slips.
TWO_SLIPS = 8


def fold(text: str) -> str:
    """Compatibility forms and accents removed, case kept."""
    text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text))
    return "".join(c for c in text if not unicodedata.combining(c))


def typing_errors(a: str, b: str, most: int = 2) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours between two words, or ``most + 1``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


class Lexicon:
    """Given names with their short forms, listed and learned, and misspellings of both recognised on the way."""

    def __init__(self, learned: list[str] = (), forms: list[tuple[str, str]] = ()):
        self.short: dict[str, set[str]] = {}
        for name, listed in SHORT_FORMS.items():
            for form in listed.split():
                self.short.setdefault(form, set()).add(name)
        for form, name in forms:
            self.short.setdefault(form, set()).add(name)
        self.formal = set(SHORT_FORMS) | {x for x in learned if x not in self.short}
        self.memo: dict[str, tuple[int, frozenset[str]]] = {}

    def read(self, word: str) -> tuple[int, frozenset[str]]:
        """(2 known, 1 misspelled, 0 unknown; the formal names it may stand for)."""
        hit = self.memo.get(word)
        if hit is None:
            if word in self.formal:
                hit = (2, frozenset([word]))
            elif word in self.short:
                hit = (2, frozenset(self.short[word]))
            else:
                hit = (0, frozenset())
                if len(word) >= 4:
                    near = {x for x in self.formal if typing_errors(word, x, 1) <= 1}
                    if not near:
                        near = {y for x, ys in self.short.items() if len(x) >= 4 and typing_errors(word, x, 1) <= 1 for y in ys}
                    if not near and len(word) >= 7:
                        near = {x for x in self.formal if len(x) >= 7 and typing_errors(word, x, 2) <= 2}
                    if near:
                        hit = (1, frozenset(near))
            if len(self.memo) < 200_000:
                self.memo[word] = hit
        return hit


_KIND_MEMO: dict[str, str | None] = {}


def abbreviates(short: str, word: str) -> bool:
    """Whether ``short`` begins as ``word`` does, is shorter by two letters or more and has its letters in their order."""
    if len(short) < 2 or len(short) > len(word) - 2 or short[0] != word[0] or (len(short) == 2 and short[1] != word[-1]):
        return False
    rest = iter(word)
    return all(c in rest for c in short)


def kind_of(word: str) -> str | None:
    if word not in _KIND_MEMO:
        plain = word[:-1] if word.endswith("s") and len(word) > 3 else word
        found = next((k for k in KINDS if k in (word, plain)), None)
        if found is None and len(word) >= 5:
            found = next((k for k in KINDS if typing_errors(word, k, 1) <= 1), None)
        if found is None:
            # a prefix before other abbreviations
            found = next((k for k in KINDS if len(plain) >= 3 and k.startswith(plain) and len(plain) <= len(k) - 2), None) or next((k for k in KINDS if abbreviates(plain, k)), None)
        if len(_KIND_MEMO) > 200_000:
            _KIND_MEMO.clear()
        _KIND_MEMO[word] = SAME_KIND.get(found, found)
    return _KIND_MEMO[word]


def parse_organisation(label: str) -> tuple[str, str] | None:
    """(own name, ``kind|subject``) of an organisation's label."""
    text = fold(label).replace("'", "")
    after_comma = re.search(r",\s*(\w[\w-]*)\W*$", text)
    words = [w.lower() for w in re.findall(r"[A-Za-z0-9]+", text)]
    while words and (words[-1] in LEGAL or (len(words) > 2 and len(words[-1]) == 1)):
        words.pop()
    letters = {w.lower() for w in re.findall(r"\b[A-Z]{2,3}\b", text)} if text != text.upper() else {w for w in words if len(w) == 2 and w not in LINKING}
    words = [w for w in words if w not in LINKING]
    if not words:
        return None
    kinds = [i for i, w in enumerate(words) if kind_of(w)]
    kind = ""
    if kinds:
        i = kinds[0] if len(kinds) == 1 else next((k for k in kinds if 0 < k), kinds[0])
        kind = kind_of(words[i]) or ""
        n = len(words)
        rest = words[:i] + words[i + 1 :]
        if not rest:
            return None
        if i == 0:
            own = rest[-1]
        elif i == n - 1 or i == 1:
            own = rest[0] if not (i == 1 and words[0] in letters and n == 3) else rest[-1]
        elif i == n - 2:
            own = rest[-1]
        else:
            own = rest[0]
    else:
        rest = words
        own = words[-1] if after_comma and after_comma.group(1).lower() == words[-1] else words[0]
    if own == rest[0]:
        subject = rest[1:]
    else:
        subject = rest[:-1]
    return own, kind + "|" + " ".join(subject)


def typed_name(label: str, lexicon: Lexicon) -> tuple[str | None, str]:
    """(family name, given name or initial as typed) of a person's label; no family name where there is none."""
    text = fold(label).replace("'", "").replace("’", "")
    head, comma, tail = text.partition(",")
    words = re.findall(r"[A-Za-z]+", text)
    words = [w for w in words if w.lower() not in TITLES]
    if len([w for w in words if len(w) > 1]) == 1 and not comma.strip(" "):
        long = next(w for w in words if len(w) > 1)
        glued = re.fullmatch(r"([A-Z][a-z]+)([A-Z][a-z]+)", long)
        if glued and len(words) == 1:
            words = list(glued.groups())
        elif len(words) == 1:
            low = long.lower()
            start = next((k for k in range(len(low) - 4, 3, -1) if low[:k] in lexicon.formal), None)
            if start:
                words = [low[:start], low[start:]]
    low = [w.lower() for w in words]
    long = [w for w in low if len(w) > 1]
    if not long:
        return None, ""
    given = None
    family = None
    before = [w.lower() for w in re.findall(r"[A-Za-z]+", head) if len(w) > 1 and w.lower() not in TITLES]
    after = [w.lower() for w in re.findall(r"[A-Za-z]+", tail) if w.lower() not in TITLES]
    if comma and before and after:
        family, given = before[-1], after[0]
    elif len(long) == 1:
        family = long[0]
        given = next((w for w in low if len(w) == 1), "")
    else:
        first, last = long[0], long[-1]
        a, b = lexicon.read(first)[0], lexicon.read(last)[0]
        family, given = (first, last) if b > a else (last, first)
    return family, given


def parse_person(label: str, lexicon: Lexicon) -> tuple[str, str] | None:
    """(family name, given) of a person's label; given is a formal name, ``a/b`` for several, ``x.`` for an initial or the word typed."""
    family, given = typed_name(label, lexicon)
    if family is None:
        return None
    if len(given) <= 1:
        return family, given + "." if given else ""
    options = lexicon.read(given)[1]
    return family, "/".join(sorted(options)) if options else given


def rest_likelihood(kind: str, variant: str, canonical: str, formal: frozenset[str] | set[str] = frozenset(SHORT_FORMS)) -> float:
    """Probability of typing the rest of a name as ``variant`` for ``canonical``; 0 where they name different things."""
    if variant == canonical:
        return 1.0
    if kind == "person":
        if not canonical or canonical.endswith("."):
            return 0.0
        if variant.endswith("."):
            return P_INITIAL if any(x[0] == variant[0] for x in canonical.split("/")) else 0.0
        if not variant:
            return 0.0
        if "/" in variant or "/" in canonical:
            common = set(variant.split("/")) & set(canonical.split("/"))
            return P_SHORT / max(1, variant.count("/") + 1) if common and "/" not in canonical else (P_SHORT / 4 if common else 0.0)
        if variant in formal and canonical in formal:
            return 0.0
        errors = typing_errors(variant, canonical)
        if errors <= 2 and min(len(variant), len(canonical)) >= 4:
            return P_TYPO if errors == 1 else P_TYPO_MORE
        if len(variant) >= 3 and (canonical.startswith(variant) or canonical.endswith(variant)):
            return P_TYPO
        return 0.0
    kind_v, _, subject_v = variant.partition("|")
    kind_c, _, subject_c = canonical.partition("|")
    p = 1.0
    if kind_v != kind_c:
        if kind_v and kind_c:
            return 0.0
        p *= P_NO_KIND if not kind_v else P_NO_KIND / 4
    if subject_v != subject_c:
        words_v, words_c = subject_v.split(), subject_c.split()
        letters = lambda ws: "".join(w[0] for w in ws)
        if len(words_v) == 1 and len(words_c) > 1 and words_v[0] == letters(words_c):
            p *= P_LETTERS
        elif len(words_c) == 1 and len(words_v) > 1 and words_c[0] == letters(words_v):
            p *= P_LETTERS / 4
        elif len(words_v) == len(words_c):
            for v, c in zip(words_v, words_c, strict=True):
                errors = typing_errors(v, c)
                if errors > 2 or (errors and min(len(v), len(c)) < 4 and v[:1] != c[:1]):
                    return 0.0
                p *= (1.0, P_TYPO, P_TYPO_MORE)[errors]
        elif not words_v and kind_v == kind_c and kind_v:
            p *= P_TYPO
        elif "".join(words_v) == "".join(words_c):
            p *= P_TYPO
        else:
            return 0.0
    return p


def log_posterior(kind: str, name: str, rest: str, n: int, to_name: str, to_rest: str, to_n: int, formal: frozenset[str] | set[str] = frozenset(SHORT_FORMS)) -> float | None:
    """Log of frequency prior times likelihood of typing (name, rest), seen ``n`` times, for the canonical form."""
    p = rest_likelihood(kind, rest, to_rest, formal)
    if p == 0.0:
        return None
    errors = typing_errors(name, to_name)
    if errors > 1 and not (errors == 2 and min(len(name), len(to_name)) >= TWO_SLIPS):
        return None
    if not errors:
        return math.log(to_n) + math.log(p)
    return math.log(p) + log_slips(n, to_n * (P_TYPO if errors == 1 else P_TYPO_MORE))


def log_slips(n: int, expected: float) -> float:
    """Log score of ``n`` records with one slip where so many are expected: the slip counts once, and copies beyond the
    expected ones count by how much rarer they are in a Poisson law."""
    usual = max(1.0, expected)
    log = math.log(expected)
    return log + (((n - usual) * log - math.lgamma(n + 1) + math.lgamma(usual + 1)) if n > usual else 0.0)


def records(spark: SparkSession, base: str) -> DataFrame:
    """(record_id, kind, label): people and organisations of entities, and decisions with rule ``none``."""
    plain = F.regexp_replace(F.lower(F.trim("entity_type")), r"^.*[:#/]", "")
    entities = read(spark, base, "entities").select(
        F.col("uri").alias("record_id"), F.when(plain.isin("person", "people"), "person").when(plain.isin("organization", "organisation", "org"), "organisation").alias("kind"), "label"
    )
    label = F.coalesce(F.when(F.trim("input_label") != "", F.col("input_label")), F.col("norm_label"))
    decisions = read(spark, base, "link_decisions").where(F.lower(F.trim("rule")) == "none")
    decisions = decisions.select(F.col("decision_id").alias("record_id"), F.lit("either").alias("kind"), label.alias("label"))
    both = entities.where("kind is not null").unionByName(decisions).where("record_id is not null and label is not null")
    return both.groupBy("record_id").agg(F.min("kind").alias("kind"), F.min("label").alias("label"))


def learned_given_names(people: DataFrame) -> list[str]:
    """Words that people's labels show to be given names: written first, or behind a comma, at least GIVEN_RECORDS times and
    with GIVEN_PARTNERS other words or more, and twice as often as they stand where family names stand.

    A word one slip away from another of them that is ten times as frequent is a misspelling of it. The list comes to the
    driver; a language has some thousands of given names, and more than MOST_GIVEN are refused."""
    words = lambda c: F.filter(F.split(F.lower(F.regexp_replace(c, r"[^\p{L} ]", " ")), r"\s+"), lambda w: (F.length(w) >= 3) & ~w.isin(*TITLES))
    parts = F.split("label", ",", 2)
    head, tail = words(parts[0]), words(F.try_element_at(parts, F.lit(2)))
    pair = F.when((F.size(tail) == 1) & (F.size(head) == 1), F.struct(tail[0].alias("given"), head[0].alias("family"))).when((F.size(parts) == 1) & (F.size(head) == 2), F.struct(head[0].alias("given"), head[1].alias("family")))
    pairs = people.select(pair.alias("p")).where("p is not null").select("p.*")
    each = pairs.select(F.explode(F.array(F.struct(F.col("given").alias("word"), F.col("family").alias("other"), F.lit(1).alias("g")), F.struct(F.col("family").alias("word"), F.col("given").alias("other"), F.lit(0).alias("g")))).alias("e")).select("e.*").where("word rlike '^[a-z]+$'")
    found = each.groupBy("word").agg(F.sum("g").alias("n"), F.count_if(F.col("g") == 0).alias("f"), F.approx_count_distinct(F.when(F.col("g") == 1, F.col("other"))).alias("partners"))
    rows = found.where((F.col("n") >= GIVEN_RECORDS) & (F.col("partners") >= GIVEN_PARTNERS) & (F.col("n") >= 2 * F.col("f"))).select("word", "n").limit(MOST_GIVEN + 1).collect()
    if len(rows) > MOST_GIVEN:
        raise ValueError(f"more than {MOST_GIVEN} words look like given names")
    near: dict[str, list[tuple[str, int]]] = {}
    for word, n in rows:
        for key in {word} | {word[:k] + word[k + 1 :] for k in range(len(word))}:
            near.setdefault(key, []).append((word, n))
    slips = {w for met in near.values() if len(met) > 1 for w, n in met for v, m in met if m >= 10 * n and typing_errors(w, v, 1) == 1}
    return sorted(w for w, _ in rows if w not in slips)


def learned_short_forms(people: DataFrame, learned: list[str]) -> list[tuple[str, str]]:
    """(short form, given name): given names that stand with the same family names far more often than by chance.

    Families are the baskets, given names the items: a short form is found with its full name in a large part of its
    families, two unrelated names only by chance. Of a pair, the name in more families is the full one; a name that has a
    fuller one itself is nobody's full name. Two forms in fewer than FORM_FAMILIES families are not learned."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(learned)
        for pdf in frames:
            found = [(family, word) for label in pdf["label"] for family, word in [typed_name(label, lexicon)] if family and len(word) > 1]
            yield pd.DataFrame(found, columns=["record", "item"])

    listed = {f for fs in SHORT_FORMS.values() for f in fs.split()} | set(SHORT_FORMS)
    baskets = people.select("label").distinct().mapInPandas(run, "record string, item string").where(F.length("item") >= 2)
    scored = pair_scores(baskets, FORM_FAMILIES, FORM_LIFT).where(F.col("n_ab") >= FORM_SHARE * F.least("n_a", "n_b"))
    rows = scored.select("item_a", "item_b", "n_a", "n_b").limit(MOST_GIVEN + 1).collect()
    if len(rows) > MOST_GIVEN:
        raise ValueError(f"more than {MOST_GIVEN} pairs look like short forms")
    fuller: dict[str, set[str]] = {}
    for a, b, n_a, n_b in rows:
        if typing_errors(a, b, 2) > 2 or min(len(a), len(b)) < 4:
            short, full = (a, b) if (n_a, a) < (n_b, b) else (b, a)
            fuller.setdefault(short, set()).add(full)
    return sorted((short, full) for short, fulls in fuller.items() if short not in SHORT_FORMS for full in fulls if full not in fuller and (full in SHORT_FORMS or full not in listed))


def nodes(labels: DataFrame, learned: list[str], forms: list[tuple[str, str]] = ()) -> DataFrame:
    """(label, kind given, kind, name, rest) of distinct labels."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(learned, forms)
        for pdf in frames:
            out = []
            for label, given_kind in zip(pdf["label"], pdf["kind"], strict=True):
                kind = given_kind
                if kind == "either":
                    words = [w.lower() for w in re.findall(r"[A-Za-z]+", fold(label))]
                    bare = [w for w in words if w not in TITLES]
                    has_given = any(lexicon.read(w)[0] for w in bare)
                    is_org = any(kind_of(w) for w in bare if len(w) > 2 and not lexicon.read(w)[0]) or (bare and bare[-1] in LEGAL) or (len([w for w in bare if len(w) > 1]) >= 3 and not has_given)
                    kind = "organisation" if is_org else "person"
                parsed = parse_person(label, lexicon) if kind == "person" else parse_organisation(label)
                if parsed:
                    out.append((label, given_kind, kind, *parsed))
            yield pd.DataFrame(out, columns=["label", "given_kind", "kind", "name", "rest"])

    return labels.mapInPandas(run, "label string, given_kind string, kind string, name string, rest string")


def attributions(spellings: DataFrame, formal: frozenset[str] = frozenset(SHORT_FORMS)) -> DataFrame:
    """(node, canonical): for every spelling (node, kind, name, rest, n) that is better explained by another, that other one."""

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for node, kind, name, rest in zip(pdf["node"], pdf["kind"], pdf["name"], pdf["rest"], strict=True):
                # people are further blocked by the initials their given name may have, organisations by their kind and by the
                # first letter of their subject: two that can be one have one of these in common
                if kind == "person":
                    blocks = {x[0] for x in rest.split("/") if x} or {"?"}
                else:
                    of_kind, _, subject = rest.partition("|")
                    blocks = {"=" + of_kind, subject[:1]}
                near = {name} | {name[:k] + name[k + 1 :] for k in range(len(name))} if len(name) >= 2 else {name}
                if len(name) >= TWO_SLIPS:
                    near |= {x[:k] + x[k + 1 :] for x in list(near) if len(x) < len(name) for k in range(len(x))}
                out.extend((node, f"{kind[0]}{block}|{key}") for block in blocks for key in near)
            yield pd.DataFrame(out, columns=["node", "key"])

    # two long names meet under many keys: the pair is kept once
    # keys travel as hashes: two that fall together only bring a pair that the score then refuses
    keyed = cut(spread(spellings.select("node", "kind", "name", "rest"), "node").mapInPandas(keys, "node bigint, key string").select("node", F.xxhash64("key").alias("key")).distinct())
    left, right = salted(keyed, keyed.select(F.col("node").alias("other"), "key"), ["key"])
    met = left.join(right, ["key", "_salt"]).where("node <> other").select("node", "other").distinct()
    side = lambda s: spellings.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("name", "rest", "n")])
    pairs = met.join(spellings, "node").join(side("other"), "other")

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = [log_posterior(*x, formal) for x in zip(pdf["kind"], pdf["name"], pdf["rest"], pdf["n"], pdf["other_name"], pdf["other_rest"], pdf["other_n"], strict=True)]
            own = [math.log(n * P_SELF) for n in pdf["n"]]
            keep = [s is not None and s > o for s, o in zip(found, own, strict=True)]
            out = pdf.loc[keep, ["node", "other", "other_n"]].copy()
            out["score"] = [s for s, k in zip(found, keep, strict=True) if k]
            yield out

    scored = pairs.mapInPandas(score, "node bigint, other bigint, other_n bigint, score double")
    best = scored.groupBy("node").agg(F.min_by("other", F.struct((-F.col("score")).alias("s"), (-F.col("other_n")).alias("n"), "other")).alias("canonical"))
    return best


def linked(spark: SparkSession, base: str) -> DataFrame:
    """(record_id, group) of every record that names somebody."""
    rows = cut(records(spark, base))
    people = rows.where("kind = 'person'")
    learned = learned_given_names(people)
    forms = learned_short_forms(people, learned)
    parsed = nodes(spread(rows.select("label", "kind").distinct(), "label"), learned, forms)
    placed = cut(rows.withColumnRenamed("kind", "given_kind").join(parsed, ["label", "given_kind"]).select("record_id", F.concat_ws("|", "kind", "name", "rest").alias("spelling"), "kind", "name", "rest"))
    counted = cut(placed.groupBy("spelling", "kind", "name", "rest").agg(F.count(F.lit(1)).alias("n")))
    seed = distinct_seed(counted, "spelling")
    number = F.xxhash64(F.lit(seed), "spelling")
    spellings = cut(counted.select(number.alias("node"), "kind", "name", "rest", "n"))
    links = cut(attributions(spellings, frozenset(Lexicon(learned, forms).formal)))
    groups = components(links.select(F.col("node").cast("string").alias("a"), F.col("canonical").cast("string").alias("b")))
    return placed.select("record_id", number.cast("string").alias("node")).join(groups, "node", "left").select("record_id", F.coalesce("component", "node").alias("group"))


def distinct_seed(rows: DataFrame, column: str) -> int:
    """A seed under which no two values of a column without repeats have the same 64-bit hash."""
    n, seed = rows.count(), 0
    while rows.select(F.xxhash64(F.lit(seed), column).alias("h")).distinct().count() < n:
        seed += 1
    return seed


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    found = cut(linked(spark, base))
    left, right = salted(found.select("group", F.col("record_id").alias("left_id")), found.select("group", F.col("record_id").alias("right_id")), ["group"])
    return left.join(right, ["group", "_salt"]).where("left_id < right_id").select("left_id", "right_id")


def p2_groups(spark: SparkSession, base: str) -> DataFrame:
    """One row per record with its group and the group's size."""
    found = cut(linked(spark, base))
    sizes = found.groupBy("group").agg(F.count(F.lit(1)).alias("records"))
    return found.join(sizes, "group").select("record_id", "group", "records")


ORACLE: dict[str, str] = {}
