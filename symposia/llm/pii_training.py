"""Training of the personal-information tagger from labelled spans.

``python -m symposia.llm.pii_training TABLES_DIR OUT.npz MINUTES`` makes labelled text without end: invented items of
each kind in public notations, set into sentences that lead to them or into the middle of plain ones, look-alikes that
are no personal items, and plain sentences read from the tables at training time (those without digits, at-signs or
pairs of capitalised words; they bear no labels). Windows of these are learned by Adam on all cores until the time is
over; the weights are written as float16. The number of labelled windows is bounded by the time given.

Names, places, domains and sentences here are general ones, written without the tables; a test asserts that no text of
this module of twelve characters or more stands in them. ``held_out=True`` draws sentences and words from lists that training
never uses, for a measure by template and by lexicon.
"""

from __future__ import annotations

import multiprocessing as mp
import random
import re
import sys
import time

import numpy as np

from symposia.llm.pii_model import PAD, TAGS, encode, loss_and_gradients, start_weights

WINDOW, BATCH = 128, 48
#: Common words of each kind, (for training, held out). Given names are the hundred most frequent ones of the last century in
#: public birth statistics, women's and men's, with some of other languages and short forms.
GIVEN = (
    (
        "james robert john michael david william richard joseph thomas christopher charles daniel matthew anthony mark steven donald andrew joshua paul kenneth kevin brian timothy ronald jason george edward jeffrey ryan jacob nicholas gary eric jonathan stephen larry justin scott brandon benjamin samuel gregory alexander patrick raymond jack dennis jerry tyler "
        "mary patricia jennifer linda elizabeth barbara susan jessica karen sarah lisa nancy sandra ashley emily kimberly margaret donna michelle carol amanda melissa deborah stephanie rebecca sharon laura cynthia amy kathleen angela shirley emma brenda pamela nicole anna samantha katherine christine debra rachel carolyn janet maria catherine heather diane "
        "hans greta lars ingrid pierre amelie luca giulia jose lucia ivan olga ahmed fatima wei mei raj anita kofi ama bob jim sue meg al jo kim lee max eve ian roy ann pam ed flo gus tess"
    ).split(),
    "frank helen walter ruth arthur alice harold doris carl edna oscar nora felix clara hugo vera bruno elsa otto marta sven astrid yusuf leila hiro yuki arjun divya tom deb rik lil dorothy betty theresa virginia jeremy zachary".split(),
)
STREETS = (
    "Oak Elm Maple Cedar Church Park Main Albert Queen King School Garden Spring River Lake Hill Forest Bridge Castle Chapel North South Bell Lincoln Green".split() + ["New Cut", "Long Acre", "Upper Ash", "Five Ways", "West End"],
    "Willow Birch Orchard Meadow Harbour Abbey Prince Grove Field Sunset".split() + ["Lower Pond", "Cross Keys"],
)
TOWNS = (
    "London Leeds Lyon Hamburg Madrid Oslo Dublin Boston Austin Denver Torino Porto Ghent Malmo Bristol Oxford Dallas Graz Bern Lille".split() + ["New York", "Port Louis", "Saint Denis", "Cape Town", "Bad Aibling", "Stoke-on-Trent"],
    "Paris Munich Sevilla Bergen Cork Seattle Houston Modena Utrecht York".split() + ["El Paso", "Fort Worth", "Newcastle-upon-Tyne"],
)
HOSTS = (
    "gmail.com outlook.com yahoo.co.uk web.de free.fr libero.it posteo.net acme.org city.gov campus.edu mailbox.example inbox.test post.invalid host.example.com".split(),
    "hotmail.com gmx.at orange.fr proton.me college.ac.uk relay.example.org".split(),
)
WAYS = "Road Street Lane Crescent Ave. Avenue Rd St. Way Close Court Terrace Drive Boulevard Blvd Place Square Row".split()
_ONSET = "b br c d dr f fl g gl gr h k kl l m n p pl pr qu r s sh sl sm sp st str t th tr v w z zh ch j y".split()
_CODA = ["", "", "", "x", "n", "s", "l", "r", "ck", "tt", "th", "ski", "sky", "nsky", "ld", "nd", "rn", "sen", "son", "burg", "man", "ez", "ova", "ley", "er"]
_B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Source(random.Random):
    """Random numbers, and from which of the two lists words and sentences come."""

    side = 0


def pick(r: Source, *xs):
    return r.choice(xs)


def digits(r: Source, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def letters(r: Source, n: int) -> str:
    return "".join(r.choice(_UPPER) for _ in range(n))


def invented(r: Source) -> str:
    word = "".join(r.choice(_ONSET) + r.choice("aeiou") for _ in range(r.choice([1, 2, 2, 3, 3, 4, 5]))) + r.choice(_CODA)
    if r.random() < 0.06:
        k = r.randrange(len(word))
        word = word[:k] + r.choice("áéíóúäöüñèç") + word[k:]
    return word.capitalize()


def street(r: Source) -> str:
    form = r.random()
    if form < 0.45:
        return r.choice(STREETS[r.side])
    if form < 0.75:
        return invented(r) + r.choice(["", "", "wick", "gate", "field", "down", "moor", "step", "by"])
    return f"{pick(r, 'Old', 'New', 'Upper', 'Great', 'Mount', 'Saint')} {invented(r)}" if form < 0.85 else f"{invented(r)} {pick(r, 'Hill', 'Rise', 'Park', 'Mill', 'Bank', 'Green')}"


def town(r: Source) -> str:
    form = r.random()
    if form < 0.4:
        return r.choice(TOWNS[r.side])
    if form < 0.8:
        return invented(r) + r.choice(["", "ton", "ford", "ham", "bury", "mouth", "wick", "sea", "field", "ville", "stadt"])
    return pick(r, f"{pick(r, 'Port', 'Saint', 'New', 'Bad', 'El')} {invented(r)}", f"{invented(r)} {pick(r, 'Bay', 'Falls', 'Heath', 'Springs', 'Beach')}", f"{invented(r)}-on-{invented(r)}", f"{invented(r)}-{invented(r)}")


def given(r: Source) -> str:
    return r.choice(GIVEN[r.side]).capitalize() if r.random() < 0.6 else invented(r)


def name(r: Source) -> str:
    g, f, i, j = given(r), invented(r), r.choice(_UPPER), r.choice(_UPPER)
    form = r.random()
    if form < 0.44:
        out = f"{g} {f}"
    elif form < 0.56:
        out = f"{f}, {g}"
    elif form < 0.66:
        out = f"{i}. {f}"
    elif form < 0.70:
        out = f"{i}.{j}. {f}"
    elif form < 0.73:
        out = f"{i}. {j}. {f}"
    elif form < 0.82:
        out = f"{g} {i}. {f}"
    elif form < 0.86:
        out = f"{f}, {i}."
    elif form < 0.89:
        out = f"{f}, {i}. {j}."
    elif form < 0.92:
        out = f"{f} {i}.{j}."
    elif form < 0.95:
        out = f"{f}, {g} {i}."
    elif form < 0.97:
        out = f"{f} {g}"
    else:
        out = f"{g} {f}-{invented(r)}"
    style = r.random()
    if style < 0.06:
        out = out.upper()
    elif style < 0.16 and f in out:
        out = out.replace(f, f.upper())
    elif style < 0.20:
        out = out.lower()
    if r.random() < 0.03:
        out = out.replace(" ", r.choice([" ", "  "]), 1)
    return out


def email(r: Source) -> str:
    g, f = given(r).lower(), invented(r).lower()
    local = pick(r, f"{g}.{f}", f"{g}_{f}", f"{f}{r.randint(1, 99)}", f"{g[0]}{f}", f"{f}-{g[0]}", f"{g}.{f}+{r.choice(['news', 'list', 'x1', 'web', 'post'])}", f"{f}", f"{g}{f}", f"{g}-{f}", f"{f}.{g[0]}", f"{g[0]}.{f}", f"{g}{digits(r, 4)}")
    if r.random() < 0.12:
        local = local.title() if r.random() < 0.6 else local.upper()
    domain = r.choice(HOSTS[r.side]) if r.random() < 0.5 else pick(r, "", "", "mail.", "dept-") + invented(r).lower() + r.choice([".example", ".org", ".test", ".co.uk", ".com", ".example.net", ".invalid", ".de", ".io"])
    if r.random() < 0.12:
        domain = domain.upper()
    at = r.random()
    if at < 0.62:
        return f"{local}@{domain}"
    if at < 0.71:
        return f"{local} @ {domain}"
    if at < 0.79:
        return f"{local}(at){domain}"
    if at < 0.82:
        return f"{local} (at) {domain}"
    return f"{local} [at] {domain.replace('.', ' [dot] ')}"


def phone(r: Source) -> str:
    """National and international notations of several countries."""
    a, b, c = digits(r, 3), r.choice(["555", digits(r, 3)]), digits(r, 4)
    sep = r.choice("-. ")
    country = r.randint(20, 99)
    pairs = sep.join(digits(r, 2) for _ in range(4))
    block = pick(r, digits(r, 6), digits(r, 7), f"{digits(r, 4)} {digits(r, 4)}", f"{digits(r, 3)} {digits(r, 4)}", f"{digits(r, 4)} {digits(r, 3)}")
    area = digits(r, r.choice([1, 2, 2, 3, 4]))
    return pick(
        r, f"{a}{sep}{b}{sep}{c}", f"({a}) {b}{sep}{c}", f"({a}) {b}-{c}", f"+1{sep}{a}{sep}{b}{sep}{c}", f"+1 ({a}) {b}-{c}", f"001 {a} {b}{c}", f"+{country} {area} {block}", f"+{country}{area}{block.replace(' ', '')}", f"+{country} (0){area} {block}", f"0{area} {block}", f"0{area}/{block.replace(' ', '')}",
        f"+{country} {area[0]} {pairs}", f"0{area[0]}{sep}{pairs}", f"00{country} {area} {block}", f"+{country} {digits(r, 3)} {digits(r, 3)} {digits(r, 3)}", f"+{country}-{area}-{block.replace(' ', '-')}", f"(0{area}) {block}",
    )


def id_number(r: Source) -> str:
    """Social security, tax, passport and national numbers in the notations of several countries, and grouped ones in general."""
    year, month, day = r.randint(1930, 2012), r.randint(1, 19), r.randint(1, 31)
    if r.random() < 0.25:
        groups = [digits(r, r.randint(2, 4)) for _ in range(r.randint(2, 4))]
        if r.random() < 0.5:
            groups[0] = letters(r, r.randint(1, 3))
        if r.random() < 0.5:
            groups[-1] = pick(r, digits(r, 1), letters(r, 1))
        out = r.choice("- ").join([groups[0], digits(r, 3), *groups[1:]])
        return out
    return pick(
        r, f"{digits(r, 3)}-{digits(r, 2)}-{digits(r, 4)}", f"9{digits(r, 2)}-{digits(r, 2)}-{digits(r, 4)}", f"{letters(r, 2)}{digits(r, 6)}{r.choice('ABCD')}", f"{letters(r, 2)} {digits(r, 2)} {digits(r, 2)} {digits(r, 2)} {r.choice('ABCD')}", f"{year}{month:02}{day:02}-{digits(r, 4)}", f"{year % 100:02}{month:02}{day:02}-{digits(r, 4)}",
        f"784-{year}-{digits(r, 7)}-{digits(r, 1)}", f"{digits(r, 8)}{letters(r, 1)}", f"{r.choice('XYZ')}{digits(r, 7)}{letters(r, 1)}", f"{digits(r, 2)} {digits(r, 3)} {digits(r, 3)} {digits(r, 3)}", f"{digits(r, 3)}.{digits(r, 3)}.{digits(r, 3)}-{digits(r, 2)}", f"{digits(r, 4)} {digits(r, 4)} {digits(r, 4)}", f"{letters(r, 1)}{digits(r, 8)}", f"{letters(r, 2)}{digits(r, 7)}", f"{letters(r, 2)}-{digits(r, 3)}-{digits(r, 3)}-{digits(r, 1)}", f"{letters(r, 1)}0{digits(r, 7)}",
    )


def address(r: Source) -> str:
    n, s, t = r.randint(1, 260), street(r), town(r)
    unit = pick(r, f"Flat {r.randint(1, 40)}", f"Apt {r.randint(1, 40)}{r.choice('ABC')}", f"Unit {r.randint(1, 30)}", f"Apt. {r.randint(1, 99)}", f"Suite {r.randint(1, 99)}")
    post = pick(r, f"{letters(r, 2)}{r.randint(1, 20)} {r.randint(0, 9)}{letters(r, 2)}", f"{letters(r, 2)} {digits(r, 5)}", digits(r, 5), digits(r, 4))
    way, comma, glued = r.choice(WAYS), r.choice(["", "", ","]), s.replace(" ", "") + r.choice(["straße", "strasse", "gasse", "weg", "allee", "platz"])
    out = pick(
        r, f"{n}{comma} {s} {way}, {t} {post}", f"{n}{comma} {s} {way}, {t}", f"{n} {s} {way}, {unit}, {t}", f"{unit}, {n} {s} {way}, {t}", f"{unit}, {n} {s} {way}, {t} {post}", f"{n}{pick(r, ' bis,', ',', ' ter,')} rue {pick(r, '', 'de ', 'du ')}{s}, {post} {t}", f"{n} rue {s}, {post} {t}",
        f"{glued} {n}{r.choice(['', 'a', 'b'])}, {t}", f"{glued} {n}, {post} {t}", f"{pick(r, 'PO', 'P.O.')} Box {n}, {t}{r.choice(['', ' ' + post])}", f"{pick(r, 'Calle', 'Via', 'via', 'Rua', 'Avenida')} {s} {n}, {t}", f"Calle {s} {n}, {r.randint(1, 9)}º, {t}", f"{n}{r.choice('AB')} {s} {way}, {t} {post}", f"{n} {s} {way}, {unit}, {t} {post}", f"via {s} {n}, {post} {t}",
    )
    return out.upper() if r.random() < 0.08 else out


ITEM = {"email": email, "phone": phone, "id_number": id_number, "address": address, "name": name}
#: Sentences that lead to an item, (for training, held out).
LEADS = {
    "email": (
        ["{}", "({})", "[{}]", "<{}>", '"{}"', "E-mail: {}", "mail={};", "cc: {}", "mailto:{}", "Reply to {} by noon.", "Any bugs? Tell {} please.", "We got nothing from {} at all.", "Old inbox {}, new one soon.", "sender {} unknown", "Forward it -> {}", "who owns {}?", "{} is full again"],
        ["Drop a line to {} if you can.", "The list admin is {}.", "bounce from {}:", "Use {} instead."],
    ),
    "phone": (
        ["{}", "({})", "[{}]", "Tel. {}", "tel={};", "fax: {}", "Ring {} after lunch.", "My cell is {} these days.", "A voice on {} said no.", "hotline {} / free", "dial {}, then wait", "Someone used {} for spam.", "reach us on {}", "{} rings all day", "Text {} to opt out."],
        ["Phone me: {}.", "The number {} was printed twice.", "SMS {} works too", "office {}, mornings"],
    ),
    "id_number": (
        ["{}", "({})", "[{}]", "ID: {}", "id={};", "SSN {}", "passport no. {}", "My tax code is {}.", "They stored {} in clear.", "the card says {}", "Citizen {} had to wait.", "insured as {} since May", "key {} leaked", "My permit, {}, expired.", "licence {} was copied", "why keep {}?"],
        ["National number {} on file.", "I am {} in their books.", "holder: {}", "Do not share {} here."],
    ),
    "address": (
        ["{}", "({})", "[{}]", "Address: {}", "addr={};", "Ship to {}, thanks.", "We rent at {} now.", "home: {}", "Letters for {} came back.", "The clinic, {}, is shut.", "Sensors near {} broke.", "born at {}", "Visit {} on Friday.", "an office at {}.", "They drove to {} twice!"],
        ["Deliver at {} only.", "The flat is in {}.", "premises {} / rear", "Come round: {}"],
    ),
    "name": (
        ["{}", "({})", "[{}]", "“{}”", "— {}", "cc {}", "by {}.", "Dr. {} spoke.", "Prof. {} wrote it", "Ms {} left", "Mr {} nodded", "Mx {} asked", "Dr {}, hello", "Prof. Dr. {} came", "Ask {} first.", "{} and I agree.", "With {} it was easy.", "{} told the panel.", "Only {} knew.", "Editor: {}", "signed {}", "{} <x>", "For {}, a win.", "Is {} here?", "my boss, {}, said so", "{} at ten", "I met {} there.", "Credit goes to {}!", "{}'s draft is fine"],
        ["We heard {} on the radio.", "Judge {} ruled.", "The chair, {}, stayed.", "Chaired by {}:", "{} replied at once."],
    ),
}


def title_words(r: Source, plain: list[str], n: int) -> str:
    """Common words of plain sentences, capitalised: what titles of boards, reports and laws are made of."""
    words: list[str] = []
    while len(words) < n:
        found = [w for w in re.findall(r"[a-z]{3,}", r.choice(plain)) if len(w) < 14]
        words += [r.choice(found).capitalize()] if found else ["Model"]
    return " ".join(words[:n])


def look_alike(r: Source, plain: list[str]) -> str:
    """Numbers, names of things and code that are nobody's data: versions, references, measures, dates, hashes, titles."""
    w, n, few = invented(r), r.randint(1, 400), r.randint(2, 3)
    date = f"20{digits(r, 2)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}"
    version = ".".join(digits(r, r.choice([1, 1, 2, 3, 4])) for _ in range(r.choice([2, 3, 3, 4])))
    title = title_words(r, plain, few)
    if r.random() < 0.25:
        # a place or project at the head of a sentence or within it
        return f"{pick(r, 'At', 'In', 'Under', 'From', 'By', 'For', 'On', 'To', 'Near', 'With', 'Since', 'Across')} {w}{pick(r, ',', ',', '', ':')} {r.choice(plain)}"
    if r.random() < 0.1:
        return pick(r, f"{n} per cent, {w}", f"{n} {title_words(r, plain, 1).lower()}, {title_words(r, plain, 1)} {w}", f"{digits(r, 1)}.{digits(r, 3)}.{digits(r, 4)}", f"v{digits(r, 2)}.{digits(r, 4)}.{digits(r, 4)}", f"{title_words(r, plain, 1).lower()} {version}")
    return pick(
        r, f"{w.lower()}@{version} is needed", f"npm i {w.lower()}@{version}", f"{w.lower()}@{pick(r, 'layer', 'head', 'main', 'dev')}", f"@{w.lower()} hi", f"The @{title_words(r, plain, 1).lower()} tag", f"on {date} at {digits(r, 2)}:{digits(r, 2)}", f"{date}T{digits(r, 2)}:{digits(r, 2)}:{digits(r, 2)}Z", f"doi:10.{digits(r, 4)}/{w.lower()}.{digits(r, 3)}.{digits(r, 4)}", f"doi 10.{digits(r, 4)}/{letters(r, 2).lower()}.{version}",
        f"{pick(r, 'ticket', 'Ticket', 'case', 'bug', 'order', 'item', 'thread')} {'-'.join(digits(r, r.randint(2, 4)) for _ in range(3))} {pick(r, 'is open', 'in our list', 'was closed', 'at the desk')}", f"issue #{digits(r, 5)}", f"case {digits(r, 3)}-{digits(r, 4)}", f"range 0.{digits(r, 3)}-0.{digits(r, 3)}, n={digits(r, 7)}", f"N = {digits(r, 7)} rows", f"Table {digits(r, 3)}-{r.randint(1960, 2020)} has {r.randint(1, 9)},{digits(r, 3)} rows", f"Fig. {digits(r, 2)}-{digits(r, 2)}", f"ISO {digits(r, 5)}:{r.randint(1990, 2024)}", f"ISO/IEC {digits(r, 2)} {digits(r, 3)}", f"EN {digits(r, 2)}-{digits(r, 2)}-{digits(r, 4)} holds", f"clause {digits(r, 2)}-{digits(r, 2)}-{digits(r, 4)}",
        f"build {version}", f"v{version} is out", f"Version {version}", f"Dataset {letters(r, 2)} {digits(r, 5)}", f"corpus {w} {digits(r, 5)}", f"the {w} {title_words(r, plain, 1)}", f"the {title}", f"{title} {pick(r, 'Act', 'Board', 'Council', 'Index', 'Charter', 'Report', 'Office', 'Framework', 'Protocol', 'Review')}", f"{w} {pick(r, 'Institute', 'Centre', 'University', 'Council', 'Agency')} for {title}", f"The {street(r)} {pick(r, 'Protocol', 'Accord', 'Report', 'Index', 'Study')}", f"{street(r)} {r.choice(WAYS)} is a title",
        f"Room {n}, Block {r.choice(_UPPER)}", f"Annex {r.choice('ABC')}, Part {n}", f"At {w}, all went well.", f"In {w}, {title_words(r, plain, 1).lower()} fell.", f"{pick(r, 'In', 'At', 'Under', 'During', 'Within', 'By', 'From', 'Per', 'After')} the {w} {pick(r, 'test', 'scheme', 'review', 'plan', 'trial', 'phase', 'rule')}, it {pick(r, 'held', 'fell', 'grew')}.", f"In {town(r)} it rains.", f"{town(r)} has {n} users", f"({w}, {n})", f"[{w} {n}]", f"({w} {r.randint(1950, 2024)})", f"{w}: a list", f"{w} said no.", f"{title}: a list", f"{title}, {title_words(r, plain, 1)}", f"| {w.lower()} | 0.{digits(r, 3)} | 0.{digits(r, 3)} |", f"(item {n})", f"(cf. {n})",
        "".join(r.choice(_B64) for _ in range(r.randint(30, 160))), "".join(r.choice("0123456789abcdef") for _ in range(r.randint(16, 64))), f"https://{w.lower()}.org/{digits(r, 4)}/{title_words(r, plain, 1).lower()}", f"www.{w.lower()}.net", f"arXiv:{digits(r, 4)}.{digits(r, 5)}", f"{digits(r, 2)}/{digits(r, 2)}/20{digits(r, 2)}", f"Section {r.randint(1, 9)}.{r.randint(1, 9)}", f"[{n}] At {w}, see", f"$ {digits(r, 3)},{digits(r, 3)}.{digits(r, 2)}", f"sha {digits(r, 8)}", f"log[{digits(r, 4)}]: {digits(r, 3)} at {digits(r, 2)}:{digits(r, 2)}:{digits(r, 2)}", f"{n} {title_words(r, plain, 1).lower()}s, {n} {title_words(r, plain, 1).lower()}s", f"{digits(r, 3)} of {digits(r, 3)}", f"{r.randint(1, 9)},{digits(r, 3)},{digits(r, 3)}.{digits(r, 2)}", f"The street was shut {n} days.", f"{title_words(r, plain, 1)} {w}", f"{w} {title_words(r, plain, 1).lower()}", f"ISBN {digits(r, 3)}-{digits(r, 1)}-{digits(r, 4)}-{digits(r, 4)}-{digits(r, 1)}", f"{pick(r, 'On', 'By', 'Since')} {pick(r, 'Monday', 'Friday')} {w} {pick(r, 'closed', 'won')}",
    )


def labelled_text(r: Source, plain: list[str], least: int) -> tuple[str, np.ndarray]:
    """A text of at least ``least`` characters with the tag of every character."""
    text, tags = [], []

    def add(s: str, kind: str | None = None) -> None:
        text.append(s)
        if kind is None:
            tags.extend([0] * len(s))
        else:
            tags.extend([TAGS.index(f"B-{kind}")] + [TAGS.index(f"I-{kind}")] * (len(s) - 1))

    while len(tags) < least:
        what = r.random()
        if what < 0.3:
            add(r.choice(plain) if r.random() < 0.97 else " ".join(r.choice(plain) for _ in range(3)).replace(". ", ", "))
        elif what < 0.48:
            add(look_alike(r, plain))
        else:
            kind = r.choice(["email", "phone", "id_number", "address", "name", "name", "name"])
            how = r.random()
            if how < 0.35:
                before, _, after = r.choice(LEADS[kind][r.side]).partition("{}")
            elif how < 0.55:
                # a label of one or two words, as of fields and headers
                word, other = title_words(r, plain, 1), title_words(r, plain, 1).lower()
                before = pick(r, "", "", "(", "[", "- ") + pick(r, word, word.lower(), f"{word.lower()}-{other}", f"{word.lower()}_{other}", f"{word}/{other}", f"{word} {other}") + pick(r, ": ", ": ", " ", "=", " -> ", ":")
                after = pick(r, "", ";", ".", "\n", " / ") if before[0] not in "([" else ")]"["([".index(before[0])]
            else:
                # in the middle, before or after a plain sentence
                words = r.choice(plain).split(" ")
                k = r.randint(0, len(words))
                before, after = " ".join(words[:k]) + pick(r, " ", " ", " ", ": ", " (", ", "), pick(r, " ", " ", ", ", ") ", ". ", " - ") + " ".join(words[k:])
            if r.random() < 0.05:
                before, after = before.lower(), after.lower()
            add(before)
            add(ITEM[kind](r), kind)
            add(after)
        add(r.choice([" ", " ", " ", " ", " ", "\n", "\n- ", ". ", ". ", "\n\n", "  ", "\r\n", " — ", "; ", ", "]) if r.random() < 0.95 else r.choice(" \n\t") * r.randint(3, 70))
    return "".join(text), np.array(tags, dtype=np.uint8)


def plain_sentences(tables: str) -> list[str]:
    """Sentences of the tables that can hold no personal item: no digit, no at-sign, no two capitalised words together."""
    import glob

    import pyarrow.parquet as pq

    from symposia.llm.reading import english

    out = set()
    for table, column in (("documents", "text"), ("answers", "body")):
        files = sorted(glob.glob(f"{tables}/{table}.parquet/*.parquet")) or [f"{tables}/{table}.parquet"]
        for text in pq.read_table(files[0], columns=[column]).column(0).to_pylist():
            # in other languages pairs of capitalised words are ordinary
            pairs = r"\b[A-Z][\w'-]*[.,]? +[A-Z]|\b[a-z]+ [A-Z]\." if english(text) else r"\b(?:[A-Z][a-z]*\. |[A-Z][a-z]+, )[A-Z]"
            for s in re.split(r"(?<=[.!?。])\s*|\n", text or ""):
                if 8 < len(s) < 200 and not re.search(r"\d|@|\bat\)|" + pairs, s):
                    out.add(s)
    return sorted(out)


def _windows(seed: int, plain: list[str]) -> tuple[np.ndarray, np.ndarray]:
    r = Source(seed)
    xs, ys = [], []
    while len(xs) < BATCH:
        text, tags = labelled_text(r, plain, WINDOW + 40)
        codes = encode(text)
        at = pick(r, 0, len(text) - WINDOW, r.randint(0, len(text) - WINDOW))
        x, y = codes[at : at + WINDOW].copy(), tags[at : at + WINDOW].copy()
        if y[0] and y[0] % 2 == 0:
            y[0] -= 1  # an item cut by the window's edge begins there
        if r.random() < 0.2 and not y[-1]:  # a text of odd length ends in one padding
            x[-1] = PAD
        xs.append(x)
        ys.append(y)
    return np.stack(xs, axis=1), np.stack(ys, axis=1)


_PLAIN: list[str] = []


def _work(job):
    seed, w = job
    x, y = _windows(seed, _PLAIN)
    return loss_and_gradients(x, y, w)


def train(tables: str, out: str, minutes: float, workers: int = 8, start: str | None = None) -> None:
    global _PLAIN
    _PLAIN = plain_sentences(tables)
    w = start_weights()
    if start:
        with np.load(start) as stored:
            w = {k: stored[k].astype(np.float32) for k in stored.files}
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v2 = {k: np.zeros_like(v) for k, v in w.items()}
    began, step = time.time(), 0
    seed0 = int(began) if start else 7
    with mp.get_context("fork").Pool(workers) as pool:
        while (done := (time.time() - began) / (60 * minutes)) < 1:
            step += 1
            rate = (0.003 if start else 0.006) * (0.5 * (1 + np.cos(np.pi * done))) + 1e-5
            results = pool.map(_work, [(seed0 + step * workers + k, w) for k in range(workers)], chunksize=1)
            grads = {k: sum(g[k] for _, g in results) / workers for k in w}
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            scale = min(1.0, 5.0 / (norm + 1e-9))
            for k in w:
                g = grads[k] * scale
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                w[k] = (w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            if step % 100 == 0:
                print(step, round(time.time() - began), "loss a window", round(sum(x for x, _ in results) / workers, 3), flush=True)
                np.savez_compressed(out, **{k: x.astype(np.float16) for k, x in w.items()})
    np.savez_compressed(out, **{k: x.astype(np.float16) for k, x in w.items()})


if __name__ == "__main__":
    train(sys.argv[1], sys.argv[2], float(sys.argv[3]), start=sys.argv[4] if len(sys.argv) > 4 else None)
