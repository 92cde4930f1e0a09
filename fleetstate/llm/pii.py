"""Surrogates for personal data: keyed replacements of the same type, gender, script and format.

Found: e-mail addresses, IPv4 and IPv6 addresses, card numbers and international account numbers whose check digits are right
(cards in groups of four also without), phone numbers, social security numbers, access keys, passwords and tokens, and names
after a title or with a known given name, with bare mentions of such a name anywhere in the text, in capitals or not.
A name that comes with neither, or only in another text, is not found.

A surrogate is a keyed permutation of all strings of the original's format, so the same entity has the same surrogate in
every document and on any cluster (coreference), two entities never share one (distinctness), and none stands for
itself: a value's rank among the strings of its format is permuted, shifted, and permuted back. Candidates that collide
with a rule of the type (private or public addresses, number ranges) are permuted on until one fits, which keeps all
that. Letters go to letters of the same alphabet, vowels to vowels, digits to digits; check digits stay right or wrong by as
much as they were; known given names go to names of the same gender and script, and other names keep the ending that tells
it. `collisions` checks a corpus for surrogates that two entities share. Whoever has the key can undo all of it, so it comes
from the caller.

A null text stays null and an empty one empty; a text of any length is read whole. An empty table gives no rows. Rows of equal text get equal results. Other columns are kept unless they
bear a name of the result. A text without findings is unchanged.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import secrets
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from math import prod

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import schema_with, table

# Alphabets whose letters stand for each other.
ALPHABETS = (
    "0123456789",
    "aeiouy",
    "bcdfghjklmnpqrstvwxz",
    "áéíóúàèìòùâêîôûäëïöü",
    "çñ",
    "аеёиоуыэюя",
    "бвгджзйклмнпрстфхцчшщъь",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψς",
    "άέήίόύώ",
    "āăąēĕėęěĩīĭįıōŏőũūŭůűųŷ",
    "ćĉċčďđĝğġģĥħĵķĺļľŀłńņňŋŕŗřśŝşšţťŧŵźżž",
)
# Signs that passwords without letters or digits are made of.
SIGNS = "!#$%&()*+-./:<=>?@[]^_{|}~"
# Endings of names that tell gender, the longest first.
ENDINGS = ("ская", "цкая", "ский", "цкий", "ова", "ева", "ина", "ska", "ski", "ая", "ов", "ев", "ин", "a", "e", "o")
# Country calling codes of one and two digits; all others have three.
CALLING_CODES = ("1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
# Given names by gender and script.
GIVEN_NAMES = {
    ("female", "latin"): "Alice Amelia Anna Barbara Carmen Caroline Charlotte Claire Elena Emily Emma Hannah Ingrid Isabelle Julia Karen Laura Linda Lucia Maria Marie Martha Mary Monika Nathalie Olivia Patricia Petra Sabine Sarah Sofia Susan Teresa Ursula",
    ("male", "latin"): "Albert Andreas Antonio Carlos Charles Daniel David Diego Edward Francois Frank George Hans Henry James Javier Jean Johann John Joseph Jürgen Karl Louis Manuel Michael Miguel Oliver Paul Pedro Peter Philippe Pierre Robert Thomas Wilhelm William Wolfgang",
    ("female", "cyrillic"): "Анна Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия",
    ("male", "cyrillic"): "Александр Алексей Андрей Дмитрий Иван Михаил Николай Павел Сергей Юрий",
    ("female", "greek"): "Αικατερίνη Ελένη Μαρία Σοφία",
    ("male", "greek"): "Γεώργιος Δημήτριος Ιωάννης Νικόλαος",
}
# Titles.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Señor Señora Monsieur Madame Mme"

_SETS = {c: (a, i) for a in ALPHABETS for i, c in enumerate(a)}
_NAMES = {name: (group, names.split()) for group, names in GIVEN_NAMES.items() for name in names.split()}


class Permuter:
    """Keyed permutations of whole numbers below some size, and of the strings of a format."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: str, i: int, half: int, width: int) -> int:
        text = f"{tweak}\0{i}\0{half}".encode()
        out, block = b"", 0
        while len(out) * 8 < width:
            out += hashlib.blake2b(text + b"\0%d" % block, key=self.key, digest_size=32).digest()
            block += 1
        return int.from_bytes(out, "big") & ((1 << width) - 1)

    def _turn(self, x: int, size: int, tweak: str, back: bool) -> int:
        """A balanced Feistel network over the next power of four, walked until the result is below `size`."""
        width = max(1, -(-(size - 1).bit_length() // 2))
        low = (1 << width) - 1
        while True:
            a, b = x >> width, x & low
            for i in range(8):
                if back:
                    a, b = b ^ self._round(tweak, 7 - i, a, width), a
                else:
                    a, b = b, a ^ self._round(tweak, i, b, width)
            x = a << width | b
            if x < size:
                return x

    def number(self, x: int, size: int, tweak: str) -> int:
        """Another number below `size`; no two go to one, and none to itself (if there are two at all)."""
        if size < 2:
            return x
        shift = 1 + self._round(tweak, 99, size % (1 << 64), 64) % (size - 1)
        return self._turn((self._turn(x, size, tweak, False) + shift) % size, size, tweak, True)

    def text(self, value: str, tweak: str, fits: Callable[[str], bool] | None = None) -> str:
        """Another string of the same format: each character of an alphabet goes to one of it, others stay."""
        sets = [_SETS.get(c) for c in value]
        sizes = [len(s[0]) for s in sets if s]
        rank = 0
        for s in sets:
            if s:
                rank = rank * len(s[0]) + s[1]
        shape = "".join(str(ALPHABETS.index(s[0])) if s else c for s, c in zip(sets, value))
        while True:
            rank = left = self.number(rank, prod(sizes), f"{tweak}\0{shape}")
            out = list(value)
            for i in range(len(value) - 1, -1, -1):
                if sets[i]:
                    left, digit = divmod(left, len(sets[i][0]))
                    out[i] = sets[i][0][digit]
            found = "".join(out)
            if fits is None or fits(found) or found == value:
                return found


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _refill(shape: str, digits: str) -> str:
    """`shape` with its digits replaced in turn."""
    source = iter(digits)
    return "".join(next(source) if c.isdigit() else c for c in shape)


def _recase(like: str, text: str) -> str:
    return "".join(c.upper() if o.isupper() else c for o, c in zip(like, text))


def _luhn(digits: str) -> int:
    """The check digit that belongs after `digits`."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _network(address: str) -> str:
    a, b = (int(x) for x in address.split(".")[:2])
    if a == 10 or (a == 172 and 16 <= b < 32) or (a == 192 and b == 168):
        return "private"
    return "loopback" if a == 127 else "special" if a == 0 or a >= 224 else "public"


def _email(p: Permuter, found: str) -> str:
    local, _, host = found.rpartition("@")
    name, _, top = host.rpartition(".")
    # The whole address is one string, so addresses that differ anywhere go to different ones.
    out = p.text(f"{local}@{name}".lower(), f"email.{top.lower()}")
    return _recase(f"{local}@{name}", out) + f".{top}"


def _address(p: Permuter, found: str) -> str:
    parts = [int(x) for x in found.split(".")]
    value, kind = int.from_bytes(bytes(parts), "big"), _network(found)
    while True:
        value = p.number(value, 1 << 32, "address")
        out = ".".join(str(b) for b in value.to_bytes(4, "big"))
        if _network(out) == kind:
            return out


def _card(p: Permuter, found: str) -> str:
    digits = _digits(found)
    off = (int(digits[-1]) - _luhn(digits[:-1])) % 10
    body = digits[0] + p.text(digits[1:-1], f"card.{len(digits)}.{digits[0]}")
    return _refill(found, body + str((_luhn(body) + off) % 10))


def _calling(found: str) -> tuple[str, str]:
    """(calling code, national digits) of a phone number. A number of ten digits without a code is one of +1."""
    digits = _digits(found)
    if found.startswith("+") or digits.startswith("00"):
        digits = digits if found.startswith("+") else digits[2:]
        code = next((c for c in CALLING_CODES if digits.startswith(c)), digits[:3])
        return code, digits[len(code) :]
    if len(digits) == 11 and digits[0] == "1":
        return "1", digits[1:]
    return ("1" if len(digits) == 10 else ""), digits


def _phone(p: Permuter, found: str) -> str:
    code, national = _calling(found)
    if not national:
        return found
    low = national[0] in "01"
    out = p.text(national, f"phone.{code}.{len(national)}.{low}", lambda x: (x[0] in "01") == low)
    digits = _digits(found)
    return _refill(found, digits[: len(digits) - len(national)] + out)


def _account_check(country: str, rest: str) -> int:
    """The two check digits of an international account number."""
    return 98 - int("".join(str(int(c, 36)) for c in f"{rest}{country}00")) % 97


def _is_account(found: str) -> bool:
    plain = found.replace(" ", "")
    return 15 <= len(plain) <= 34 and int(plain[2:4]) == _account_check(plain[:2], plain[4:])


def _account(p: Permuter, found: str) -> str:
    plain = found.replace(" ", "")
    rest = p.text(plain[4:].lower(), f"account.{plain[:2]}").upper()
    source = iter(f"{plain[:2]}{_account_check(plain[:2], rest):02d}{rest}")
    return "".join(c if c == " " else next(source) for c in found)


def _long_address(p: Permuter, found: str) -> str:
    # The first 16 bits tell the kind of address and stay.
    value = int(ipaddress.IPv6Address(found))
    top, size = value >> 112, 1 << 112
    return str(ipaddress.IPv6Address(top << 112 | p.number(value % size, size, f"address6.{top}")))


def _is_long_address(found: str) -> bool:
    try:
        address = ipaddress.IPv6Address(found)
    except ValueError:
        return False
    # Without any digit it is more likely a name in a program.
    return any(c.isdigit() for c in found) and not (address.is_unspecified or address.is_loopback)


def _security(p: Permuter, found: str) -> str:
    fits = lambda x: x[:3] not in ("000", "666") and x[0] != "9" and x[3:5] != "00" and x[5:] != "0000"
    return _refill(found, p.text(_digits(found), "security", fits))


def _secret(p: Permuter, found: str) -> str:
    # Hexadecimal stays hexadecimal; other secrets are permuted letter by letter, in lower case, with their capitals.
    if re.fullmatch(r"[0-9a-f]+", found):
        size = 16 ** len(found)
        return f"{p.number(int(found, 16), size, f'hex.{len(found)}'):0{len(found)}x}"
    head = 4 if re.match(r"AKIA|ASIA|ghp_", found) else 0
    lower = found[head:].lower()
    if not any(c in _SETS for c in lower):
        return _signs(p, found)
    capitals = "".join("A" if c.isupper() else "a" for c in found[head:])
    return found[:head] + _recase(found[head:], p.text(lower, f"secret.{found[:head]}.{capitals}", lambda x: [c.isdigit() for c in x] == [c.isdigit() for c in lower]))


def _signs(p: Permuter, found: str) -> str:
    """Another password of signs; one of neither signs nor known letters becomes a keyed hash."""
    if not any(c in SIGNS for c in found):
        return hashlib.blake2b(found.encode(), key=p.key, digest_size=16).hexdigest()
    rank, shape = 0, "".join("s" if c in SIGNS else c for c in found)
    for c in found:
        rank = rank * len(SIGNS) + SIGNS.index(c) if c in SIGNS else rank
    many = sum(c in SIGNS for c in found)
    rank, out = p.number(rank, len(SIGNS) ** many, f"signs.{shape}"), []
    for c in reversed(found):
        if c in SIGNS:
            rank, place = divmod(rank, len(SIGNS))
            c = SIGNS[place]
        out.append(c)
    return "".join(reversed(out))


def _ending(word: str) -> str:
    """The ending of a name that tells gender, if more than two letters stand before it."""
    return next((e for e in ENDINGS if word.endswith(e) and len(word) > len(e) + 2), "")


def _name_word(p: Permuter, word: str) -> str:
    known = _NAMES.get(word) or _NAMES.get(word.title())
    if known:
        group, names = known
        order = sorted(names, key=lambda n: hashlib.blake2b(n.encode(), key=p.key).digest())
        new = order[(order.index(word if word in names else word.title()) + 1) % len(order)]
        return new.upper() if word.isupper() else new.lower() if word.islower() else new
    # A word that is no known name must not become one, nor one of another ending, or it could meet that name's own surrogate.
    lower = word.lower()
    ending = _ending(lower)
    stem = lower[: len(lower) - len(ending)]
    fits = lambda x: (x + ending).title() not in _NAMES and _ending(x + ending) == ending
    return _recase(word, p.text(stem, f"name.{ending}" if ending else "name", fits) + ending)


_HEX = r"[0-9a-f]"
PATTERNS: tuple[tuple[str, re.Pattern, Callable[[Permuter, str], str]], ...] = (
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.+%-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?!\w)", re.A), _email),
    ("secret", re.compile(rf"\b(?:AKIA|ASIA)[A-Z0-9]{{16}}\b|\bghp_\w{{36}}\b|(?i:(?<=password=)|(?<=passwd=)|(?<=secret=)|(?<=token=)|(?<=api_key=))[^\s\"',;]{{6,}}|(?i:(?<=token = \")|(?<=secret = \")|(?<=password = \")|(?<=api_key = \"))[^\s\"]{{6,}}|\b{_HEX}{{32,128}}\b", re.A), _secret),
    ("account", re.compile(r"(?<![\w-])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w-])", re.A), _account),
    ("address6", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:.])", re.A), _long_address),
    ("address", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w])(?!\.\d)", re.A), _address),
    ("security", re.compile(r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])", re.A), _security),
    ("card", re.compile(r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?)(?![\w-])", re.A), _card),
    ("phone", re.compile(r"(?<![\w.])(?:(?:\+|00)\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)", re.A), _phone),
)
# Names: a capital and letters, capitals inside too, in parts joined by a hyphen or apostrophe.
_PART = r"\p{Lu}[\p{L}\p{M}]*(?:['’]\p{Lu}?[\p{L}\p{M}]+)*"
_WORD = rf"{_PART}(?:-{_PART})*"
_TITLED = regex.compile(rf"\b(?:{'|'.join(TITLES.split())})\b\.? ({_WORD}(?: {_WORD}){{0,2}})")
_KNOWN = regex.compile(rf"\b(?:{'|'.join(sorted(_NAMES))}) {_WORD}(?!\w)")


def _names(text: str) -> list[tuple[int, int]]:
    """Spans of the single words of names: after a title, or a known given name and the word after it; and each mention of
    such a word alone, in capitals or small letters too, also before the name is given in full."""
    spans = [m.span(1) for m in _TITLED.finditer(text)] + [m.span() for m in _KNOWN.finditer(text)]
    if not spans:
        return []
    words = {w.casefold() for a, b in spans for w in re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)*", text[a:b]) if len(w) > 1}
    once = regex.compile(r"(?<!\w)\L<words>(?!\w)", regex.IGNORECASE, words=sorted(words, key=len, reverse=True))
    return [m.span() for m in once.finditer(text)]


# What a pattern alone does not say.
_REALLY = {
    "phone": lambda found: 8 <= len(_digits(found)) <= 15,
    "card": lambda found: " " in found or "-" in found or _luhn(found[:-1]) == int(found[-1]),
    "account": _is_account,
    "address6": _is_long_address,
}


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, type) of what stands in a text, in order, none overlapping; earlier patterns come first."""
    spans: list[tuple[int, int, str]] = []
    if re.search(r"[@\d]|AKIA|ASIA|ghp_|[=\"]|::", text):
        for kind, pattern, _ in PATTERNS:
            for m in pattern.finditer(text):
                if kind not in _REALLY or _REALLY[kind](m.group()):
                    spans.append((*m.span(), kind))
    spans += [(a, b, "name") for a, b in _names(text)]
    order = {kind: i for i, (kind, *_) in enumerate(PATTERNS)} | {"name": len(PATTERNS)}
    out: list[tuple[int, int, str]] = []
    for a, b, kind in sorted(spans, key=lambda s: (s[0], order[s[2]])):
        while out and a < out[-1][1] and order[kind] < order[out[-1][2]]:
            out.pop()
        if not out or a >= out[-1][1]:
            out.append((a, b, kind))
    return out


class Surrogates:
    """Surrogates under one key; those of a process' latest entities are kept at hand."""

    def __init__(self, key: bytes):
        self.permuter = Permuter(key)
        self.makers = {kind: maker for kind, _, maker in PATTERNS} | {"name": _name_word}
        self.of = lru_cache(maxsize=1 << 16)(self._of)

    def _of(self, kind: str, value: str) -> str:
        return self.makers[kind](self.permuter, value)

    def replace(self, text: str) -> tuple[str, list[dict]]:
        """The text with surrogates, and their types and spans in it, with a keyed hash of the entity replaced."""
        out, found, at, size = [], [], 0, 0
        for a, b, kind in find(text):
            new = self.of(kind, text[a:b])
            out += [text[at:a], new]
            size += a - at
            who = hashlib.blake2b(f"{kind}\0{canonical(kind, text[a:b])}".encode(), key=self.permuter.key, digest_size=16).hexdigest()
            found.append({"type": kind, "start": size, "stop": size + len(new), "entity": who})
            size += len(new)
            at = b
        return "".join([*out, text[at:]]) if found else text, found


def canonical(kind: str, value: str) -> str:
    """What two mentions of one entity share."""
    if kind in ("email", "name"):
        return value.lower()
    if kind == "phone":
        return " ".join(_calling(value))
    if kind == "address6":
        return ipaddress.IPv6Address(value).exploded
    if kind == "account":
        return value.replace(" ", "")
    return _digits(value) if kind in ("card", "security") else value


_ENTITY = pa.struct([("type", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("entity", pa.string())])


def _replace_batches(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    surrogates = Surrogates(key)
    for batch in batches:
        rest = [n for n in batch.schema.names if n != "_text"]
        texts, found = [], []
        for text in batch.column("_text"):
            text = text.as_py()
            new, entities = (None, []) if text is None else surrogates.replace(text)
            texts.append(new)
            found.append(entities)
        columns = [*(batch.column(n) for n in rest), pa.array(texts, pa.string()), pa.array(found, pa.list_(_ENTITY))]
        yield pa.record_batch(columns, names=[*rest, "text", "entities"])


def with_surrogates(docs: DataFrame, key: str) -> DataFrame:
    """The columns of `docs` with the new text, and `entities`: type, span in the new text, keyed hash of the original."""
    rest = [c for c in docs.columns if c not in ("text", "entities", "_text")]
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], F.col("text").cast("string").alias("_text"))
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    more = "text string, entities array<struct<type: string, start: bigint, stop: bigint, entity: string>>"
    return rows.mapInArrow(partial(_replace_batches, key=secret), schema_with(rows, ("_text",), more))


def collisions(replaced: DataFrame) -> DataFrame:
    """(type, surrogate, entities): surrogates that stand for more than one entity of a corpus. There should be none.

    A surrogate's mentions are compared as those of an entity are: without case, and numbers without punctuation.
    """
    one = replaced.select("text", F.explode("entities").alias("e")).select(
        "e.type", "e.entity", F.expr("substring(text, cast(e.start + 1 as int), cast(e.stop - e.start as int))").alias("surrogate")
    )
    digits = F.regexp_replace("surrogate", r"\D", "")
    plain = F.when(F.col("type").isin("email", "name"), F.lower("surrogate")).when(F.col("type").isin("card", "security"), digits)
    # A phone number with its calling code.
    bare = F.when(F.length(digits) == 10, F.concat(F.lit("1"), digits)).otherwise(digits)
    called = F.when(F.startswith("surrogate", F.lit("+")), digits).when(F.startswith(digits, F.lit("00")), F.substring(digits, 3, 40)).otherwise(bare)
    plain = plain.when(F.col("type") == "account", F.replace("surrogate", F.lit(" "))).when(F.col("type") == "phone", called)
    plain = plain.otherwise(F.col("surrogate"))
    pairs = one.select("type", plain.alias("surrogate"), "entity").distinct()
    return pairs.groupBy("type", "surrogate").agg(F.count(F.lit(1)).alias("entities")).filter("entities > 1")


def op8_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    """The key is the session's spark.fleetstate.surrogateKey; without one, a new one that nobody knows is used each time."""
    key = spark.conf.get("spark.fleetstate.surrogateKey", None) or secrets.token_hex(32)
    found = with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    return found.select("doc_id", "text", F.size("entities").cast("bigint").alias("n_entities"), "entities")
