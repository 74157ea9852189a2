"""Personal data replaced by keyed surrogates of the same type, script, gender and format.

A surrogate is a keyed function of the entity's normal form, so that every mention of an entity, in
any document and task, gets the same one without any exchange. Over the whole corpus, distinct entities
are checked for collisions: one whose surrogate another has taken, or which is somebody's real value,
tries again with the next attempt. Texts are rewritten with the attempts that came out.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runweave.llm.common import content_key, fresh, map_arrow, small_in_bytes, stored, text_batches

# --- fixed values: forms of address by gender, given names by gender and script ----
TITLES = {
    "m": ["Mr", "Mr.", "Mister", "Herr", "Herrn", "Monsieur", "M.", "Señor", "Sr.", "Don"],
    "f": ["Mrs", "Mrs.", "Ms", "Ms.", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra.", "Doña"],
    "n": ["Dr.", "Prof.", "Professor"],
}
GIVEN = {
    ("m", "LATIN"): ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Daniel",
                     "Hans", "Jürgen", "Wolfgang", "Pierre", "François", "Jacques", "Carlos", "José", "Miguel"],
    ("f", "LATIN"): ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Emily",
                     "Ursula", "Sabine", "Monika", "Marie", "Françoise", "Chloé", "María", "Carmen", "Lucía"],
    ("m", "CYRILLIC"): ["Иван", "Сергей", "Алексей", "Дмитрий", "Николай", "Андрей", "Михаил", "Павел"],
    ("f", "CYRILLIC"): ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна", "Ирина", "Светлана"],
    ("m", "GREEK"): ["Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Παναγιώτης", "Γιάννης"],
    ("f", "GREEK"): ["Μαρία", "Ελένη", "Αικατερίνη", "Βασιλική", "Σοφία", "Αγγελική"],
}
# --- fixed values: what stands inside a name, and capitalised words that end one ----
PARTICLES = (
    "von vom van zu zum zur der den dem de del della dello di da do dos das du des la las le los el al ibn bin bint "
    "ben ter ten te af av"
).split()
ENDS = frozenset(
    "jr sr ii iii iv md phd esq mr mrs ms miss dr prof the this that these those and or but nor if then when while where "
    "who whom whose which what why how in on at of for from by to with as is are was were has have had will would can "
    "could may might must not he she it they we you his her their our your its no yes also however monday tuesday "
    "wednesday thursday friday saturday sunday january february march april june july august september october "
    "november december".split()
)
# --- fixed values: words of a name in a script without case, which does not show where it ends ---
UNCASED_WORDS = 3
# --- fixed values: syllables of made-up names, and endings by gender ---------------
SYLLABLES = {
    "LATIN": "ba be bo bra da de do dra fa fe fo ga go gra ka ke ko kra la le lo ma me mo na ne no pa ro sa ta".split(),
    "CYRILLIC": "ба бо ва во га го да до за зо ка ко ла ло ма мо на но па по ра ро са со та то".split(),
    "GREEK": "βα βο γα γο δα δο κα κο λα λο μα μο να νο πα πο ρα ρο σα σο τα το".split(),
    "CJK": list("安柏成达恩方冠海嘉凯朗明宁平庆瑞思涛文欣雅永泽志"),
    "ARABIC": "با دا را سا فا كا لا ما نا بو دو رو سو كو لو مو نو".split(),
    "HEBREW": "בא דא גא לא מא נא רא סא בו דו גו לו מו נו רו סו".split(),
    "DEVANAGARI": "का गा ता दा ना पा बा मा रा ला सा को गो तो दो नो मो रो लो सो".split(),
}
ENDINGS = {
    ("m", "LATIN"): "n", ("f", "LATIN"): "lia", ("n", "LATIN"): "m",
    ("m", "CYRILLIC"): "н", ("f", "CYRILLIC"): "лия", ("n", "CYRILLIC"): "м",
    ("m", "GREEK"): "ς", ("f", "GREEK"): "λια", ("n", "GREEK"): "ν",
}
ALPHABETS = {
    "LATIN": "abcdefghijklmnopqrstuvwxyz",
    "CYRILLIC": "абвгдежзиклмнопрстуфхцчшщэюя",
    "GREEK": "αβγδεζηθικλμνξοπρστυφχψω",
    "CJK": "安柏成达恩方冠海嘉凯朗明宁平庆瑞思涛文欣雅永泽志",
    "ARABIC": "بتجحدرسطفقكلمنهوي",
    "HEBREW": "אבגדהוזחטיכלמנסעפצקרשת",
    "DEVANAGARI": "कगचजटडतदनपबमयरलवसह",
}
# ------------------------------------------------------------------------------------

KINDS = ("secret", "email", "ipv6", "iban", "card", "ssn", "phone", "ip", "given", "surname", "initial")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_GAP = r"[^\w\n@+]{0,6}"
_FOUND = re.compile(
    r"""(?:token|secret|api[_-]?key|access[_-]?key|passw(?:or)?d|pwd)["']?\s*[:=]\s*["']?(?P<secret>[\w\-/+=.]{8,})"""
    r"|(?<!\w)(?P<hex>[0-9a-f]{32,})(?!\w)"
    r"|(?<!\w)(?P<known>(?:ghp_|gho_|AKIA|sk-|xox[bp]-)[\w-]{10,})"
    r"|(?P<email>(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)+)"
    r"|(?<![\w:.])(?P<ipv6>(?=[0-9a-f]{0,4}:[0-9a-f]{0,4}:)[0-9a-f:]{2,39}(?:(?<=:)(?:%(o)s\.){3}%(o)s)?)(?![\w:]|\.\d)"
    r"|(?<!\w)(?P<iban>[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?!\w)"
    r"|(?<![\w.])(?P<ip>(?:%(o)s\.){3}%(o)s)(?!\w|\.\d)"
    r"|(?P<phone>(?<!\w)\+[1-9](?:%(g)s\d){7,14}(?!\w)"
    r"|(?<![\w(])\(\d{3}\)[ ]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]))"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?<!\w)(?P<card>\d{13,19}|\d{4}(?P<s>[ -])\d{4}(?P=s)\d{4}(?P=s)\d{4}|\d{4}(?P<r>[ -])\d{6}(?P=r)\d{5})(?!\w)"
    % {"o": _OCTET, "g": _GAP},
    re.IGNORECASE,
)
_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_GIVEN = {n: key[0] for key, names in GIVEN.items() for n in names}
_GENDER_OF = {n.casefold(): g for n, g in _GIVEN.items()}


def _any(words) -> str:
    return "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))


#: A word of a name, without a possessive ending.
_MARKS = "".join(chr(c) for c in range(0x300, 0x1100) if unicodedata.category(chr(c))[0] == "M")
_NAME = rf"[^\W\d_](?:[\w{_MARKS}]|['’-](?!s\b)(?=\w))+"
_WORD = re.compile(rf"(?<!\w){_NAME}")
_PREFIXED = re.compile(r"(?:d|l|dell|dall|al|el)['’-](?=\w)", re.IGNORECASE)
_START = re.compile(
    rf"(?<![\w.])(?:(?P<title>{_any(_GENDER)})(?:[ ]+(?:Dr\.?|Prof\.?|Professor)(?=[ ]))*(?=[ ])"
    rf"|(?P<given>{_any(_GIVEN)})(?=[ ]))"
)
_STEP = re.compile(
    rf"(?P<gap>[ ]*)(?:(?:{_any(PARTICLES)})[ ]+)*(?:(?P<initial>[^\W\d_])(?:\.|(?=[ ]))|(?P<name>{_NAME})(?!\w))"
)


def _is_name(word: str) -> bool:
    m = _PREFIXED.match(word)
    return (word[m.end() if m else 0].isupper() or _uncased(word)) and word.casefold() not in ENDS


def _uncased(word: str) -> bool:
    return word[0].lower() == word[0].upper()


def _people(text: str) -> list[tuple[str, bool, list[tuple[int, int, bool]]]]:
    """``(gender, titled, parts)`` of the full names of a text; a part is ``(start, end, initial)``."""
    out, pos = [], 0
    while m := _START.search(text, pos):
        pos = at = m.end()
        title, dotted = m["title"], False
        parts = [] if title else [(*m.span("given"), False)]
        waiting = []
        while (step := _STEP.match(text, at)) and (step["gap"] or dotted):
            at = step.end()
            if step["initial"]:
                if not step["initial"].isupper():
                    break
                dotted = text[at - 1] == "."
                waiting.append((*step.span("initial"), True))
                continue
            if not _is_name(step["name"]) or (not title and _uncased(step["name"])):
                break
            if _uncased(step["name"]) and len(parts) == UNCASED_WORDS:
                break
            parts += [*waiting, (*step.span("name"), False)]
            waiting, dotted, pos = [], False, at
        names = [text[a:b] for a, b, initial in parts if not initial]
        if len(names) > (0 if title else 1):
            gender = _GENDER[title] if title else "n"
            if gender == "n" and len(names) > 1:
                gender = _GENDER_OF.get(names[0].casefold(), "n")
            out.append((gender, bool(title), parts))
    return out


def _named(text: str) -> tuple[list[tuple[int, int, str, str]], dict[str, tuple[str, str]]]:
    """Mentions of the full names of a text, and ``(kind, normal form)`` by each name found, case-folded.

    What one mention leaves open another tells: the gender of a given name after a neutral title,
    whether a single name after a title is a given name, whether a middle name is a surname.
    """
    people = _people(text)
    if not people:
        return [], {}
    genders, first, last, alone = {}, set(), set(), set()
    for gender, _, parts in people:
        names = [text[a:b].casefold() for a, b, initial in parts if not initial]
        (last if len(names) > 1 else alone).add(names[-1])
        first.update(names[:1] if len(names) > 1 else ())
        for n in names[:-1]:
            genders.setdefault(n, []).append(gender)
    out, known = [], {}
    for gender, _, parts in people:
        whole = [x for x in parts if not x[2]]
        for a, b, initial in parts:
            value = text[a:b].casefold()
            script = _script(value)
            if initial:
                out.append((a, b, "initial", f"n {script} {value}"))
                continue
            given = (a, b, initial) != whole[-1]
            if given and value in last | alone and value not in _GENDER_OF and (a, b, initial) != whole[0]:
                given = False
            elif len(whole) == 1 and value in first and value not in last:
                given = True
            if given:
                seen = [g for g in genders[value] if g != "n"]
                # A single name after a title may be of a gender that no full name has.
                g = seen[0] if seen and (gender == "n" or (len(whole) == 1 and gender not in seen)) else gender
                entity = ("given", f"{g} {script} {value}")
            else:
                entity = ("surname", f"n {script} {value}")
            out.append((a, b, *entity))
            old = known.setdefault(value, entity)
            if old[0] != entity[0] and entity[0] == ("given" if value in _GENDER_OF else "surname"):
                known[value] = entity
    return out, known


def _bare(text: str, known: dict[str, tuple[str, str]]) -> list[tuple[int, int, str, str]]:
    """The mentions of single names that ``known`` has, alone or inside a hyphenated word."""
    out = []
    for m in _WORD.finditer(text):
        word, at = m[0], m.start()
        if (entity := known.get(word.casefold())) and _is_name(word):
            out.append((at, m.end(), *entity))
        elif re.search("['’-]", word):
            for part in re.finditer("[^'’-]+", word):
                if (entity := known.get(part[0].casefold())) and _is_name(part[0]):
                    out.append((at + part.start(), at + part.end(), *entity))
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def _iban_rest(plain: str) -> int:
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _script(text: str) -> str:
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "LATIN").split()[0]
            return name if name in ALPHABETS else "LATIN"
    return "LATIN"


def mentions(text: str | None) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, normal form)`` of the entities of one text, in order, without overlaps.

    Numbers count as cards or IBANs only with the right check digits. A name follows a form of address
    or is a known given name with a capitalised one after it, and goes on over capitalised words,
    particles and initials; the normal form of its parts tells gender and script, so that ``Ms. Smith``
    and ``Sarah Smith`` share the surname's surrogate. Names found so are found again where they stand alone.
    """
    if not text:
        return []
    out = []
    for m in _FOUND.finditer(text) if re.search("[0-9@=:]", text) else ():
        kind, value = m.lastgroup, ""
        for kind in ("secret", "hex", "known", "email", "ipv6", "iban", "ip", "phone", "ssn", "card"):
            if m[kind] is not None:
                value = m[kind]
                break
        at = m.span(kind)
        if kind in ("hex", "known"):
            kind = "secret"
        digits = _digits(value)
        if kind == "card" and (_luhn(digits) or not digits.strip("0")):
            continue
        if kind == "iban":
            plain = value.replace(" ", "").upper()
            if not plain.isascii() or _iban_rest(plain) != 1:
                continue
            norm = plain
        elif kind == "ipv6":
            try:
                address = ipaddress.IPv6Address(value)
            except ValueError:
                continue
            if not int(address) >> 1:
                continue
            norm = str(address)
        elif kind == "phone":
            if value[0] == "+":
                # The zero in brackets is not dialled after a country code.
                digits = _digits(value.replace("(0)", "", 1))
                if not 8 <= len(digits) <= 15:
                    continue
            norm = digits if value[0] == "+" or len(digits) != 10 else f"1{digits}"
        elif kind in ("card", "ssn"):
            norm = digits
        else:
            norm = value if kind == "secret" else value.lower()
        out.append((*at, kind, norm))
    named, known = _named(text)
    # Of mentions that start together the longest counts.
    kept = _apart(sorted([*out, *named], key=lambda x: (x[0], -x[1])))
    if known:
        kept = _apart(sorted([*kept, *_outside(_bare(text, known), kept)]))
    return kept


def _apart(found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    kept, end = [], 0
    for x in found:
        if x[0] >= end:
            kept.append(x)
            end = x[1]
    return kept


def _outside(found: list[tuple[int, int, str, str]], kept: list[tuple[int, int, str, str]]):
    """Those of ``found`` that touch none of ``kept``; both are in order."""
    i = 0
    for x in found:
        while i < len(kept) and kept[i][1] <= x[0]:
            i += 1
        if i == len(kept) or kept[i][0] >= x[1]:
            yield x


class _Stream:
    """A keyed stream of numbers."""

    def __init__(self, key: bytes, *what) -> None:
        self.seed = hashlib.blake2b("\0".join(map(str, what)).encode(), key=key).digest()
        self.pool, self.n = 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            self.n += 1
            block = hashlib.blake2b(self.seed + self.n.to_bytes(4, "big")).digest()
            self.pool = self.pool << 512 | int.from_bytes(block, "big")
        self.pool, x = divmod(self.pool, n)
        return x


def _same_form(text: str, s: _Stream) -> str:
    """Each letter by one of its script and case, each digit by a digit."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(s.below(10)))
        elif c.isalpha():
            letters = ALPHABETS[_script(c)]
            new = letters[s.below(len(letters))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, norm: str, attempt: int, key: bytes) -> str:
    """The normal form of the replacement of an entity: another value of the same kind."""
    turn = 0
    while (new := _drawn(kind, norm, attempt, _Stream(key, kind, norm, attempt, turn), key)) == norm:
        turn += 1
    return new


def _drawn(kind: str, norm: str, attempt: int, s: _Stream, key: bytes) -> str:
    if kind == "email":
        local, _, domain = norm.partition("@")
        # One domain stays one domain; the reserved name keeps mail from real people.
        label = _same_form(re.sub(r"[^\w]", "", domain.split(".")[0]) or "x", _Stream(key, "domain", domain))
        return f"{_same_form(local, s)}{'x' * attempt}@{label}.example.org"
    if kind == "ip":
        return ".".join(str(1 + s.below(254)) for _ in range(4))
    if kind == "ipv6":
        return ":".join(f"{s.below(1 << 16):x}" for _ in range(8))
    if kind == "card":
        body = norm[0] + "".join(str(s.below(10)) for _ in norm[1:-1])
        return body + str(-_luhn(body + "0") % 10)
    if kind == "ssn":
        return "9" + "".join(str(s.below(10)) for _ in norm[1:])
    if kind == "phone":
        head = norm[: 1 if norm[0] in "17" else 2]
        body = [str(s.below(10)) for _ in norm[len(head) :]]
        if body:
            body[0] = str(2 + s.below(8))
        if norm[len(head) + 3 : len(head) + 6] == "555" and attempt < 4:
            body[3:6] = "555"
        return head + "".join(body)
    if kind == "iban":
        body = "".join(str(s.below(10)) if c.isdigit() else "ABCDEFGHJKLMNPRSTUVWXYZ"[s.below(23)] for c in norm[4:])
        return norm[:2] + f"{98 - _iban_rest(norm[:2] + '00' + body):02d}" + body
    if kind == "initial":
        gender, script, _ = norm.split(" ", 2)
        return f"{gender} {script} {ALPHABETS[script][s.below(len(ALPHABETS[script]))]}"
    if kind in ("given", "surname"):
        gender, script, value = norm.split(" ", 2)
        names = GIVEN.get((gender, script), [])
        if kind == "given" and attempt == 0 and names:
            return f"{gender} {script} {names[s.below(len(names))].casefold()}"
        some = SYLLABLES[script]
        made = "".join(some[s.below(len(some))] for _ in range(3 + attempt // 2))
        return f"{gender} {script} {made}{ENDINGS.get((gender, script), '')}"
    if re.fullmatch("[0-9a-fA-F]+", norm):
        digits = "0123456789abcdef" if not re.search("[A-F]", norm) else "0123456789ABCDEF"
        return "".join(digits[s.below(16)] for _ in norm)
    head = re.match(r"(?:ghp_|gho_|AKIA|sk-|xox[bp]-)?", norm)[0]
    return head + _same_form(norm[len(head) :], s)


def _shaped(kind: str, new: str, mention: str) -> str:
    """The replacement in the format of a mention: its separators, its capitals."""
    if kind in ("phone", "card", "ssn"):
        shown = mention.replace("(0)", "()", 1) if kind == "phone" and mention[0] == "+" else mention
        digits = iter(new[-len(_digits(shown)) :])
        out = "".join(next(digits) if c.isdigit() else c for c in shown)
        return out if shown == mention else out.replace("()", "(0)", 1)
    if kind == "iban":
        chars = iter(new)
        return "".join(c if c == " " else next(chars) for c in mention)
    if kind in ("given", "surname", "initial"):
        new = new.split(" ", 2)[2]
        return new.upper() if mention.isupper() and len(mention) > 1 else new.title()
    if kind == "email" and mention.isupper():
        return new.upper()
    return new


def rewrite(text: str | None, attempts: dict[tuple[str, str], int], key: bytes) -> tuple[str | None, int]:
    """A text with its entities replaced, and their number."""
    found = mentions(text)
    if not found:
        return text, 0
    out, last = [], 0
    for start, end, kind, norm in found:
        new = surrogate(kind, norm, attempts.get((kind, norm), 0), key)
        out += [text[last:start], _shaped(kind, new, text[start:end])]
        last = end
    return "".join([*out, text[last:]]), len(found)


def entities(docs: DataFrame) -> DataFrame:
    """``(key, kind, norm)``: the entities of each text, once a text; ``key`` stands for the text.

    Initials are left out: there are fewer letters than people, so they cannot differ.
    """

    def run(batches):
        for batch in text_batches(batches, "text"):
            keys, kinds, norms = [], [], []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                for kind, norm in sorted({x[2:] for x in mentions(text) if x[2] != "initial"}):
                    keys.append(k)
                    kinds.append(kind)
                    norms.append(norm)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(kinds, pa.string()), pa.array(norms, pa.string())],
                names=["key", "kind", "norm"],
            )

    return map_arrow(docs.select(content_key().alias("key"), "text"), run, "key binary, kind string, norm string")


def _with_surrogates(df: DataFrame, key: bytes) -> DataFrame:
    """``(kind, norm, attempt)`` with the surrogate of that attempt in ``new``."""

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "norm", "attempt")))
            made = pa.array([surrogate(*row, key) for row in rows], pa.string())
            yield batch.append_column("new", made)

    return map_arrow(df.select("kind", "norm", "attempt"), run, "kind string, norm string, attempt int, new string")


def settle(found: DataFrame, key: bytes) -> DataFrame:
    """``(kind, norm, attempt)`` of the entities that cannot have their first surrogate.

    ``found`` are distinct ``(kind, norm)``. A surrogate is free if it is no entity's real value and nobody
    holds it; of several that want it the first by normal form gets it, the others try again. Each
    round is narrow joins over those that still try, and only their number comes to the driver.
    """
    real = found.select("kind", F.col("norm").alias("new"))
    trying = stored(_with_surrogates(found.withColumn("attempt", F.lit(0)), key), "pii-try")
    held, moved = None, []
    while True:
        free = trying.join(real, ["kind", "new"], "left_anti")
        if held is not None:
            free = free.join(held, ["kind", "new"], "left_anti")
        won = free.groupBy("kind", "new").agg(F.min(F.struct("norm", "attempt")).alias("w"))
        won = stored(won.select("kind", "new", "w.norm", "w.attempt"), "pii-won")
        moved.append(won.where("attempt > 0").select("kind", "norm", "attempt"))
        mine = won.select("kind", "new")
        held = mine if held is None else held.union(mine)
        lost = trying.join(won.select("kind", "norm"), ["kind", "norm"], "left_anti")
        lost = lost.select("kind", "norm", (F.col("attempt") + 1).alias("attempt"))
        trying = stored(_with_surrogates(lost, key), "pii-try")
        if trying.isEmpty():
            break
    out = moved[0]
    for more in moved[1:]:
        out = out.union(more)
    return stored(out, "pii-moved")


def replace(docs: DataFrame, key: bytes, count: str | None = "n_entities") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and their number in ``count`` unless that is None.

    All other columns stay as they are; one that is named like ``count`` is replaced. A null text stays
    null with 0 entities, repeated rows and copies get equal texts, an empty table stays empty.
    """
    found = stored(entities(docs), "pii-found")
    moved = settle(found.select("kind", "norm").distinct(), key)
    key_name, moved_name = fresh("key", docs.columns), fresh("moved", docs.columns)
    changes = (
        found.join(moved, ["kind", "norm"])
        .distinct()
        .groupBy(F.col("key").alias(key_name))
        .agg(F.collect_list(F.struct("kind", "norm", "attempt")).alias(moved_name))
    )
    # A row lists the moved entities of one text, so rows have no bound: their bytes are counted.
    changes = stored(changes, "pii-changes")
    size = F.aggregate(moved_name, F.lit(32), lambda a, m: a + 48 + F.octet_length(m["norm"]))
    kept = [c for c in docs.columns if c != count]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], content_key().alias(key_name))
    rows = rows.join(small_in_bytes(changes, size), key_name, "left").drop(key_name)
    fields = [rows.schema[c] for c in kept]
    place = kept.index("text")

    def run(batches):
        for batch in text_batches(batches, "text"):
            texts = batch.column("text").to_pylist()
            new, numbers = [], []
            for text, moves in zip(texts, batch.column(moved_name).to_pylist()):
                attempts = {(m["kind"], m["norm"]): m["attempt"] for m in moves or ()}
                t, n = rewrite(text, attempts, key)
                new.append(t)
                numbers.append(n)
            columns = batch.columns[: len(kept)]
            columns[place] = pa.array(new, pa.string())
            if count:
                columns.append(pa.array(numbers, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *([count] if count else [])])

    schema = T.StructType([*fields, *([T.StructField(count, T.IntegerType())] if count else [])])
    return rows.mapInArrow(run, schema)
