"""Surrogates for personal data: keyed, of the same kind and format, distinct for distinct entities, equal for equal ones.

An entity's surrogate is drawn from a keyed hash of (kind, canonical value, attempt), so every task computes it alone and all
mentions in all documents agree. Two checks keep entities apart over the whole corpus: a surrogate must belong to one entity
only, and must not be an entity that occurs. Entities that fail take their next attempt until none fails. As failures are rare, only they
are stored and looked up: they travel with the second pass while they are few (``exception_limit``, counted first), else they
are joined to the texts that need them. Plain text is never shuffled.

Kinds and what their surrogates keep: email (shape of the local part; the domain becomes a reserved one), card number (length,
separators, first digit, validity of the check digit), phone (separators, country code), IPv4 (private stays private), IPv6,
MAC, SSN, IBAN (country, valid check digits), secrets such as tokens (length, classes of characters), names (gender, script,
case; first and last name are replaced apart, so 'Mr Smith' still refers to 'John Smith').
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import drop_named, extended, fresh, stored, text_key

#: Names by script, gender and part. Any script without a list keeps its names' shape with letters of its own.
NAMES = {
    ("latin", "f"): "Alice Anna Clara Diana Elena Emma Ingrid Julia Laura Lucia Maria Marta Nora Paula Rosa Sofia Teresa Vera".split(),
    ("latin", "m"): "Adam Albert Anton Carlos David Erik Felix Henry Hugo Jonas Karl Lucas Martin Oscar Pablo Robert Simon Victor".split(),
    ("latin", "n"): "Alex Andrea Charlie Jamie Jordan Kim Morgan Robin Sam Sascha Taylor Toni".split(),
    ("latin", "last"): (
        "Adler Bauer Becker Blanc Brandt Carter Castillo Dubois Ellis Fischer Fontaine Garcia Hansen Herrera Hughes Keller Klein "
        "Lambert Lopez Marchand Meyer Moreau Navarro Palmer Parker Renard Romero Schubert Torres Turner Vogel Walker Weber"
    ).split(),
    ("cyrillic", "f"): "Анна Вера Елена Ирина Мария Нина Ольга Светлана".split(),
    ("cyrillic", "m"): "Алексей Борис Виктор Иван Николай Олег Павел Сергей".split(),
    ("cyrillic", "n"): "Саша Женя Валя".split(),
    ("cyrillic", "last"): "Белый Громов Долгих Зимин Котов Лебедь Морозов Седых Черных Шевчук".split(),
    ("greek", "f"): "Άννα Ελένη Ειρήνη Μαρία Σοφία".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Κώστας Νίκος Πέτρος".split(),
    ("greek", "n"): "Άρης Φοίβη".split(),
    ("greek", "last"): "Αλεξίου Βασιλείου Γεωργίου Δημητρίου Νικολάου".split(),
}
MALE = "Mr Mister Herr Herrn Monsieur M Sr Señor Don Signor г-н господин κύριος".split()
FEMALE = "Mrs Ms Miss Frau Madame Mme Mlle Sra Señora Doña Signora г-жа госпожа κυρία".split()
OTHER = "Dr Prof Professor Doctor Docteur".split()
GIVEN = {n: g for (_, g), names in NAMES.items() if g != "last" for n in names if len(n) > 3}
GIVEN |= dict.fromkeys("James John Michael William Thomas Peter Hans Klaus Pierre Jean Louis José Juan Miguel Paul".split(), "m")
GIVEN |= dict.fromkeys("Mary Jennifer Linda Elizabeth Susan Sarah Karen Petra Sabine Claire Marie Camille Carmen Isabel".split(), "f")

_WORD = r"[^\W\d_][^\W\d_]*(?:['’-][^\W\d_]+)*"
_TITLES = "|".join(re.escape(t) for t in sorted([*MALE, *FEMALE, *OTHER], key=len, reverse=True))
#: In the order in which they claim text.
PATTERNS = (
    ("secret", re.compile(r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{16,}|xox[abp]-[A-Za-z0-9-]{10,}"
                          r"|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{6,}|[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])")),
    ("secret", re.compile(r"(?i)(?<![a-z0-9])(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|auth)[\"']?\s*[=:]\s*[\"']?([^\s\"',;]{6,})")),
    ("email", re.compile(r"[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("mac", re.compile(r"(?<![\w:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![\w:-])")),
    ("ipv6", re.compile(r"(?:(?<![\w:.])|(?<=[G-Zg-z]:))(?=[0-9A-Fa-f:]*:[0-9A-Fa-f]*:)[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,8}(?:(?:\.\d{1,3}){3})?(?![\w:]|\.\d)")),
    ("ipv4", re.compile(r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}(?!\w|\.\d)")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("card", re.compile(r"(?<![\w.-])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?\(\d{2,5}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\w)"
                         r"|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])")),
)
TITLED = re.compile(rf"(?<!\w)({_TITLES})\.?[ \t]+(?=[^\W\d_])")
WORDS = re.compile(rf"{_WORD}(?: {_WORD}){{0,2}}")
GIVEN_FIRST = re.compile(rf"(?<!\w)({'|'.join(sorted(map(re.escape, GIVEN), key=len, reverse=True))}) ({_WORD})(?!\w)")
TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 "
    "93 94 95 98".split()
)
#: Attempts after which a kind whose own space may be used up draws from a larger one.
WIDER = 8
#: Texts without any of these hold nothing to find but names.
HINT = re.compile(r"[0-9@=:]")


def script_of(text: str) -> str:
    for c in text:
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
        if "一" <= c <= "鿿" or "぀" <= c <= "ヿ" or "가" <= c <= "힯":
            return "east"
    return "latin"


def _proper(word: str) -> bool:
    return word[:1].isupper() and len(word) > 1


def ipv6(mention: str) -> str | None:
    """The eight full groups of an address in any of its forms; None for other text and for '::', which is no one's address."""
    if mention == "::":
        return None
    try:
        return ipaddress.IPv6Address(mention).exploded
    except ValueError:
        return None


def country_code(digits: str) -> str:
    """The calling code that international digits start with; no code starts another one."""
    size = 1 if digits[:1] in ("1", "7") else 2 if digits[:2] in TWO_DIGIT_CODES else 3
    return digits[:size]


def find_entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of all entities, in order, without overlaps.

    Kinds of names: ``first_f``, ``first_m``, ``first_n``, ``last``; each word of a name is an entity of its own.
    """
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []
    if HINT.search(text):
        for kind, pattern in PATTERNS:
            group = pattern.groups
            for m in pattern.finditer(text):
                start, end = m.span(group)
                if kind == "ipv6":
                    mention = m.group()
                    if mention.endswith(":") and not mention.endswith("::"):  # a colon of the sentence
                        mention, end = mention[:-1], end - 1
                    canonical = ipv6(mention)
                    if canonical is None:
                        continue
                elif kind == "phone" and m.group().startswith("+"):
                    canonical = "+" + re.sub(r"\D", "", m.group())
                elif kind in ("card", "phone", "iban"):
                    canonical = re.sub(r"[^0-9A-Za-z]", "", m.group(group))
                else:
                    canonical = m.group(group) if kind == "secret" else m.group(group).lower()
                found.append((start, end, kind, canonical))
    for m in TITLED.finditer(text):
        title, words = m.group(1), WORDS.match(text, m.end())
        gender = "m" if title in MALE else "f" if title in FEMALE else "n"
        found.extend(_name(words.group(), m.end(), gender))
    for m in GIVEN_FIRST.finditer(text):
        if _proper(m.group(2)):
            found.extend(_name(m.group(), m.start(), GIVEN[m.group(1)]))
    rank = {kind: k for k, (kind, _) in enumerate(PATTERNS)}
    claimed: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []
    for e in sorted(found, key=lambda e: (rank.get(e[2], 99), e[0])):
        if all(e[1] <= a or e[0] >= b for a, b in taken):
            taken.append((e[0], e[1]))
            claimed.append(e)
    return sorted(claimed)


def _name(words: str, at: int, gender: str) -> Iterator[tuple[int, int, str, str]]:
    parts, here = [], at
    for word in words.split(" "):
        if not _proper(word):
            break
        parts.append((here, word))
        here += len(word) + 1
    for k, (start, word) in enumerate(parts):
        last = k == len(parts) - 1
        kind = "last" if last and (len(parts) > 1 or word not in GIVEN) else f"first_{GIVEN.get(word, gender)}"
        yield start, start + len(word), kind, word.lower()


class Draw:
    """Endless keyed digits and choices for one (kind, value, attempt)."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int) -> None:
        self.seed = hmac.new(key, f"{kind}\0{value}\0{attempt}".encode("utf-8", "replace"), hashlib.sha256).digest()
        self.state, self.block = 0, 0

    def below(self, n: int) -> int:
        if self.state < n << 64:
            self.block += 1
            more = hashlib.sha256(self.seed + self.block.to_bytes(8, "little")).digest()
            self.state = (self.state << 256) | int.from_bytes(more, "little")
        self.state, out = divmod(self.state, n)
        return out

    def like(self, shape: str, hexadecimal: bool = False) -> str:
        """Random characters of the same classes; others stay."""
        out = []
        for c in shape:
            if c.isdigit() and c.isascii():
                out.append("0123456789abcdef"[self.below(10)])
            elif c.isascii() and c.isalpha():
                letters = "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz"
                drawn = letters[self.below(len(letters))]
                out.append(drawn.upper() if c.isupper() else drawn)
            elif c.isalpha():
                out.append("abcdefghijklmnopqrstuvwxyz"[self.below(26)] if script_of(c) == "latin" else chr(ord(c) ^ self.below(2)))
            else:
                out.append(c)
        return "".join(out)


def luhn(digits: str) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """Canonical surrogate of a canonical value: as it is found again in the written text, so what is checked is what is written."""
    draw = Draw(key, kind, value, attempt)
    wider = attempt // WIDER
    if kind == "email":
        local, _, domain = value.partition("@")
        top = domain.rpartition(".")[2]
        return f"{draw.like(local + 'a' * wider)}@{draw.like(domain.split('.')[0])}.example.{top if top in ('com', 'org', 'net') else 'com'}"
    if kind == "card":
        body = value[0] + draw.like(value[1:])
        if luhn(value) == 0:
            body = next(c for c in (body[:-1] + str(d) for d in range(10)) if luhn(c) == 0)
        return body
    if kind == "iban":
        body = value[:2] + "00" + draw.like(value[4:])
        number = int("".join(str(int(c, 36)) for c in body[4:] + body[:4]))
        return f"{value[:2]}{98 - number % 97:02d}{body[4:]}"
    if kind == "ipv4":
        a, b, *_ = (int(x) for x in value.split("."))
        rest = f"{draw.below(256)}.{1 + draw.below(254)}"
        private = 0 if (a, b) == (192, 168) else 1 if a == 172 and 16 <= b < 32 else 2 if a == 10 else None
        if private is not None:  # a range that is used up gives way to the next larger private one
            private = min(2, private + wider)
        if private == 2:
            return f"10.{draw.below(256)}.{rest}"
        if private == 0:
            return f"192.168.{rest}"
        if private == 1:
            return f"172.{16 + draw.below(16)}.{rest}"
        return f"{(11 + draw.below(80), 101 + draw.below(60))[draw.below(2)]}.{draw.below(256)}.{rest}"
    if kind == "ipv6":  # link-local and unique local addresses stay such, others move to the range of documentation
        old = ipaddress.IPv6Address(value)
        head, bits = (0xFE80 << 112, 64) if old.is_link_local else (0xFD << 120, 120) if value[:2] in ("fc", "fd") else (0x20010DB8 << 96, 96)
        # The top bit of the drawn part is set, so that the written form is never shorter than its own kind of address.
        return ipaddress.IPv6Address(head | 1 << (bits - 1) | draw.below(1 << (bits - 1))).exploded
    if kind == "mac":
        return draw.like(value, hexadecimal=True)
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}-{1 + draw.below(99):02d}-{1 + draw.below(9999):04d}"
    if kind == "phone":  # the country code says no more than the script would
        code = f"+{country_code(value[1:])}" if value[0] == "+" else ""
        return code + draw.like(value[len(code) :])
    if kind == "secret":
        if wider:  # hardly any letters or digits to draw
            value = "".join(c if c.isalnum() and c.isascii() else "a" for c in value) + "a" * (wider - 1)
        return draw.like(value, hexadecimal=not re.search(r"[g-zG-Z]", value))
    script, part = script_of(value), kind.removeprefix("first_")
    names = NAMES.get((script, part))
    if names is None:  # a script without lists: characters near the ones there
        return "".join(chr(ord(c) + 1 + draw.below(3)) for c in value + value[-1] * (attempt // 4))
    name = names[draw.below(len(names))].lower()
    for _ in range(attempt // 4):  # a list used up: double names, then longer ones
        name += f"-{names[draw.below(len(names))].lower()}"
    return name


def dress(kind: str, mention: str, new: str) -> str:
    """A canonical surrogate in the format of one mention: its separators and its case."""
    if kind in ("card", "phone", "iban"):
        fresh_chars = iter(new.removeprefix("+"))
        return "".join(next(fresh_chars) if c.isalnum() else c for c in mention)
    if kind == "ipv6":
        groups = mention.split(":")
        full = "::" not in mention and all(len(g) == 4 for g in groups)
        short = new if full else str(ipaddress.IPv6Address(new))
        return short.upper() if mention.isupper() else short
    if kind == "secret":
        return new
    if kind.startswith("first_") or kind == "last":
        return new.upper() if mention.isupper() else "-".join(p[:1].upper() + p[1:] for p in new.split("-"))
    return new.upper() if mention.isupper() and kind in ("mac", "email") else new


def replace_in(
    text: str | None, surrogate_of: Callable[[str, str], str]
) -> tuple[str | None, list[tuple[int, int, str]]]:
    """The text with surrogates, and the replaced spans (start and end in the old text, kind)."""
    spans = find_entities(text)
    if not spans:
        return text, []
    out, at = [], 0
    for start, end, kind, value in spans:
        out += [text[at:start], dress(kind, text[start:end], surrogate_of(kind, value))]
        at = end
    return "".join(out) + text[at:], [(s, e, k) for s, e, k, _ in spans]


def assign_exceptions(docs: DataFrame, text_col: str, key: bytes, rounds: int = 200) -> DataFrame:
    """``kind``, ``value``, ``attempt`` of all entities whose first surrogate is taken by another entity or occurs itself.

    Each round checks all entities against all: the owner of a surrogate is the entity settled earlier, then the smaller
    one; every other claimant, and whoever drew a value that occurs in the corpus, tries its next attempt. Conflicting surrogates are
    never returned: if some are left after ``rounds`` (a kind with more entities than its widest space can bear), it is an error.
    """
    source = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {(kind, value) for t in batch.column(0) for _, _, kind, value in find_entities(t.as_py())}
            kinds, values = zip(*seen, strict=True) if seen else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["kind", "value"]
            )

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[c.to_pylist() for c in batch.columns[:3]], strict=True)
            drawn = [surrogate(key, kind, value, attempt) for kind, value, attempt in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.string())], names=drawn_names)

    drawn_names = ["kind", "value", "attempt", "drawn"]
    entities = source.mapInArrow(find, "kind string, value string").distinct()
    state = stored(entities.withColumn("attempt", F.lit(0)), "entities")
    originals = state.select("kind", F.col("value").alias("drawn"), F.lit(True).alias("occurs"))
    for _ in range(rounds):
        drawn = state.mapInArrow(draw, "kind string, value string, attempt int, drawn string")
        owner = drawn.groupBy("kind", "drawn").agg(F.min(F.struct("attempt", "value")).alias("owner"))
        judged = drawn.join(owner, ["kind", "drawn"]).join(originals, ["kind", "drawn"], "left")
        lost = F.col("occurs").isNotNull() | (F.col("owner.value") != F.col("value"))
        after = judged.select("kind", "value", (F.col("attempt") + F.when(lost, 1).otherwise(0)).alias("attempt"), lost.alias("lost"))
        after = stored(after, "attempts")
        state = after.select("kind", "value", "attempt")
        if after.where("lost").isEmpty():
            return state.where("attempt > 0")
    left = {r["kind"]: r["count"] for r in after.where("lost").groupBy("kind").count().collect()}
    raise RuntimeError(f"surrogates still in conflict after {rounds} rounds, by kind: {left}")


def pseudonymise(
    docs: DataFrame, key: bytes, text_col: str = "text", exception_limit: int = 100_000
) -> DataFrame:
    """All columns and rows of ``docs`` with surrogates in the text; adds ``n_entities`` and ``entity_spans``.

    ``entity_spans`` holds start, end (code points of the old text) and kind. NULL texts stay NULL with no entities, empty ones stay
    empty. Equal texts get equal results; repeated rows stay repeated. Columns of the added names are replaced.
    """
    exceptions = assign_exceptions(docs, text_col, key)
    few = exceptions.limit(exception_limit + 1).collect()  # at most exception_limit + 1 rows
    added = ("n_entities", "entity_spans")
    lookup = fresh([*docs.columns, *added], "attempts_now")
    base = drop_named(docs, added)
    base = base.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    if len(few) <= exception_limit:
        table = {(r["kind"], r["value"]): r["attempt"] for r in few}
        base = base.withColumn(lookup, F.lit(None).cast("map<string,int>"))
    else:
        table = {}
        base = _with_attempts(base, exceptions, text_col, lookup)
    at, more = base.columns.index(text_col), base.columns.index(lookup)
    schema = extended(
        base.drop(lookup).schema, "n_entities bigint, entity_spans array<struct<start:int,end:int,kind:string>>"
    )
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text, own in zip(batch.column(at), batch.column(more), strict=True):
                own = dict(own.as_py() or ())

                def of(kind: str, value: str, own: dict = own) -> str:
                    attempt = own.get(f"{kind}\0{value}", table.get((kind, value), 0))
                    return surrogate(key, kind, value, attempt)

                new, found = replace_in(text.as_py(), of)
                texts.append(new)
                spans.append([{"start": s, "end": e, "kind": k} for s, e, k in found])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            del columns[more]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([len(s) for s in spans], pa.int64()), pa.array(spans, span_type)], names=schema.names
            )

    return base.mapInArrow(run, schema)


def _with_attempts(docs: DataFrame, exceptions: DataFrame, text_col: str, name: str) -> DataFrame:
    """Join to every text the attempts of those of its entities that are exceptions."""
    keyed = docs.select(text_key(text_col).alias("k"), F.col(f"`{text_col}`").alias("text"))

    def mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {
                (k, kind, value)
                for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for _, _, kind, value in find_entities(t)
            }
            columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["k", "kind", "value"])

    found = keyed.mapInArrow(mentions, "k string, kind string, value string").distinct().join(exceptions, ["kind", "value"])
    pair = F.struct(F.concat_ws("\0", "kind", "value").alias("key"), F.col("attempt").alias("value"))
    by_text = found.groupBy("k").agg(F.map_from_entries(F.collect_list(pair)).alias(name))
    at = fresh([*docs.columns, name], "key_now")
    return docs.withColumn(at, text_key(text_col)).join(by_text.withColumnRenamed("k", at), at, "left").drop(at)
