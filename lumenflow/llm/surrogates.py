"""Personal data in texts replaced by keyed surrogates of the same kind and form.

Detected are e-mail addresses, IPv4 addresses, phone numbers, payment card numbers
and names after a title; of a name found so, later and earlier mentions in the same text, whole or one
word of it, are the same entity and get the same surrogate or its word. An entity has a canonical form (case and separators don't
count), and its surrogate depends on a secret key, its kind, that form and an
attempt number only, so the same entity has the same surrogate wherever and however
it is written. Surrogates keep the form: separators, lengths, upper and lower case,
a card's first digit and whether its check digit is right, a phone's country code, a
name's script and the gender that its title tells. IPv4 surrogates are in 240.0.0.0/4,
which is never routed, and e-mail surrogates in the reserved example domains.

Two checks over the whole corpus keep entities apart: no two entities of a kind may have
the same surrogate, and no surrogate may be an entity that the corpus holds. Losers
are given the next attempt until none is left; later attempts widen the form (longer names and local parts, further ranges
of numbers), so that entities may outnumber the surrogates of their own length. If numbers of a fixed length are used up all the same,
an error says so after ``MOST_ROUNDS`` rounds. Both are joins of the distinct entities
only. Texts without entities pass by; texts with them meet the attempts above zero,
which are rare, by a join on the text's hash and id, and are rewritten in the task.

Defined results: a null text stays null and an empty one empty; overlapping finds
go to the first that begins, and of these to the longer; very long texts are read whole; null ids and equal ids are kept apart by their texts; repeated rows are rewritten
alike; an empty table gives an empty table; other columns pass through, those named like
an output are replaced.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from lumenflow.llm.minmax import staged
from lumenflow.llm.textops import add_columns

_EMAIL = re.compile(r"(?<![\w.+-])[\w.+-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-])")
_IPV4 = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)")
_CARD = re.compile(r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d-])")
_PHONE = re.compile(
    r"(?<![\w+.-])(?:\+?\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-]|\.\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,4}(?![\w-]|\.\d)"
)
#: What an address, a card or a phone number has at least; most texts have none and are done.
_DIGITS = re.compile(r"[0-9][0-9 .()-]{5,}[0-9]")
# Titles by gender, and given names by script and gender.
_TITLES = {
    "m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Don", "г-н", "Господин", "Κύριος", "Κος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Señorita", "Madame", "Mme", "Mlle", "Doña", "г-жа", "Госпожа", "Κυρία", "Κα"),
}
_GIVEN = {
    ("LATIN", "m"): "Adam Boris Carl David Emil Felix Georg Henry Ivan Jonas Karim Leo Martin Noah Oscar Paul",
    ("LATIN", "f"): "Anna Bella Clara Diana Emma Flora Greta Helen Irene Julia Karen Laura Maria Nora Olga Paula",
    ("CYRILLIC", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Никита Олег Павел Роман Семён Юрий",
    ("CYRILLIC", "f"): "Анна Белла Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Юлия",
    ("GREEK", "m"): "Άγγελος Βασίλης Γιώργος Δημήτρης Ηλίας Θανάσης Κώστας Λευτέρης Μανώλης Νίκος Πέτρος Σταύρος",
    ("GREEK", "f"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Λυδία Μαρία Νίκη Σοφία",
}
_SYLLABLES = {
    "LATIN": "ba be bo da de di fa fe ga go ha he ka ke ko la le li lo ma me mi mo na ne no pa pe ra re ro sa se so ta te ti to va ve vo",
    "CYRILLIC": "ба бо ва ве во га го да де до за ка ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то",
    "GREEK": "βα βε βο γα γο δα δε δο κα κο λα λε λο μα με μο να νε νο πα πο ρα ρε ρο σα σε σο τα τε το",
}
_ENDING = {("CYRILLIC", "m"): "в", ("CYRILLIC", "f"): "ва", ("GREEK", "m"): "ς", ("GREEK", "f"): "υ"}
_EVERY_TITLE = sorted((t for titles in _TITLES.values() for t in titles), key=len, reverse=True)
_GENDER = {t: g for g, titles in _TITLES.items() for t in titles}
_NAME = re.compile(rf"\b({'|'.join(map(re.escape, _EVERY_TITLE))})\.?[  ]((?:[^\W\d_][\w'’-]*)(?:[  ][^\W\d_][\w'’-]*){{0,2}})")

#: (kind, canonical form, start, end, form, part): form tells what a surrogate has to keep besides the text itself,
#: part which word of a name a mention is (-1: the whole).
Entity = tuple[str, str, int, int, str, int]
#: Words of names shorter than this aren't looked for alone.
LEAST_MENTION = 3
#: Rounds of settling after which the space of some form is taken to be used up.
MOST_ROUNDS = 100
_TOKEN = re.compile(r"[^\W\d_][\w'’-]*")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _found(text: str) -> Iterator[Entity]:
    if "@" in text:
        for m in _EMAIL.finditer(text):
            yield "email", m.group().lower(), m.start(), m.end(), "", -1
    numbers = _DIGITS.search(text) is not None
    for m in _IPV4.finditer(text) if numbers else ():
        yield "ipv4", ".".join(str(int(x)) for x in m.group().split(".")), m.start(), m.end(), "", -1
    for m in _CARD.finditer(text) if numbers else ():
        yield "card", re.sub(r"\D", "", m.group()), m.start(), m.end(), "", -1
    for m in _PHONE.finditer(text) if numbers else ():
        digits = re.sub(r"\D", "", m.group())
        if 9 <= len(digits) <= 15:
            yield "phone", digits, m.start(), m.end(), re.match(r"\+?\d*", m.group()).group() if m.group()[0] == "+" else "", -1
    for m in _NAME.finditer(text):
        words = re.split("[  ]", m.group(2))
        while words and not words[-1][0].isupper():
            words.pop()
        upper = 0
        while upper < len(words) and words[upper][0].isupper():
            upper += 1
        if upper:
            name = m.group(2)[: sum(map(len, words[:upper])) + upper - 1]
            if name.endswith(("'s", "’s")):  # a possessive isn't part of the name
                name, words[upper - 1] = name[:-2], words[upper - 1][:-2]
            yield "name", " ".join(words[:upper]).casefold(), m.start(2), m.start(2) + len(name), _GENDER[m.group(1)], -1


def find(text: str) -> list[Entity]:
    """The entities of a text, none overlapping another."""
    out: list[Entity] = []
    for e in sorted(_found(text), key=lambda e: (e[2], -e[3])):
        if not out or e[2] >= out[-1][3]:
            out.append(e)
    names = [e for e in out if e[0] == "name"]
    return sorted(out + _mentions(text, names, out), key=lambda e: e[2]) if names else out


def _mentions(text: str, names: list[Entity], taken: list[Entity]) -> list[Entity]:
    """Where the text speaks of its titled names without a title: by the whole name or one word of it.

    A word that several names share means the one named last before it, or the first one if none was.
    """
    whole: dict[str, list[tuple[list[str], Entity]]] = {}  # by first word
    single: dict[str, tuple[Entity, int]] = {}

    def know(e: Entity, again: bool) -> None:
        words = re.split("[  ]", text[e[2] : e[3]])
        if len(words) > 1:
            group = whole.setdefault(words[0], [])
            group[:] = [(words, e), *[g for g in group if g[0] != words]]
        for k, word in enumerate(words):
            if len(word) >= LEAST_MENTION and (again or word not in single):
                single[word] = (e, k if len(words) > 1 else -1)

    for e in names:
        know(e, False)
    tokens = [(m.start(), m.group()) for m in _TOKEN.finditer(text)]
    spans = iter([*sorted((e[2], e[3], e) for e in taken), (len(text) + 1, 0, None)])
    begin, end, entity = next(spans)
    out: list[Entity] = []
    last = 0
    for i, (start, token) in enumerate(tokens):
        while end and start >= end:
            if entity[0] == "name":
                know(entity, True)
            begin, end, entity = next(spans)
        word = token[:-2] if token.endswith(("'s", "’s")) else token
        stop = start + len(word)
        if start < last or stop > begin or not word[0].isupper():
            continue
        for words, e in whole.get(word, ()):
            size = len(words)
            follow = [w for _, w in tokens[i : i + size]]
            if len(follow) == size:
                follow[-1] = words[-1] if follow[-1] in (f"{words[-1]}'s", f"{words[-1]}’s") else follow[-1]
                stop_all = tokens[i + size - 1][0] + len(words[-1])
                if follow == words and stop_all <= begin and re.split("[  ]", text[start:stop_all]) == words:
                    out.append(("name", e[1], start, stop_all, e[4], -1))
                    last = stop_all
                    break
        else:
            if found := single.get(word):
                out.append(("name", found[0][1], start, stop, found[0][4], found[1]))
                last = stop
    return out


class Stream:
    """Keyed numbers that depend on the entity only."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{canonical}\0{attempt}".encode(), hashlib.sha256).digest()
        self.block, self.at, self.number = b"", 0, 0

    def below(self, n: int) -> int:
        if self.at + 8 > len(self.block):
            self.block = hashlib.sha256(self.seed + self.number.to_bytes(4, "big")).digest()
            self.number, self.at = self.number + 1, 0
        value = int.from_bytes(self.block[self.at : self.at + 8], "big")
        self.at += 8
        return value % n

    def like(self, c: str) -> str:
        """A character of the same class and case (of ASCII; a letter beyond it becomes an ASCII one)."""
        if c.isdigit():
            return str(self.below(10))
        if c.isalpha():
            new = chr(97 + self.below(26))
            return new.upper() if c.isupper() else new
        return c


def script(text: str) -> str:
    for c in text:
        if c.isalpha():
            first = unicodedata.name(c, "LATIN").split(" ")[0]
            return first if first in _SYLLABLES else "LATIN"
    return "LATIN"


#: Attempts after which a form is widened: longer names and addresses, more ranges of numbers.
WIDER = 4


def surrogate(key: bytes, kind: str, canonical: str, attempt: int, form: str = "") -> str:
    """The canonical form of the replacement; ``dressed`` gives it the look of the original."""
    rng = Stream(key, kind, canonical, attempt)
    if kind == "email":
        local, _, domain = canonical.rpartition("@")
        # the domain has a stream of its own, so addresses of one domain stay together
        host = Stream(key, "domain", domain, 0)
        label = "".join(host.like(c) for c in domain.split(".")[0] if c.isalnum()) or "x"
        # 60 random bits: two domains share one about never, however short they are
        label += "-" + "".join("abcdefghijklmnopqrstuvwxyz234567"[host.below(32)] for _ in range(12))
        more = "".join(rng.like("a") for _ in range(attempt // WIDER))
        return f"{''.join(rng.like(c) for c in local)}{more}@{label}.example.{('com', 'net', 'org')[host.below(3)]}"
    if kind == "ipv4":
        first = 240 + rng.below(15) if attempt < 4 * WIDER else 1 + rng.below(254)  # reserved addresses as long as there are any
        return ".".join(map(str, (first, rng.below(256), rng.below(256), 1 + rng.below(254))))
    if kind == "card":
        body = canonical[0] + "".join(str(rng.below(10)) for _ in canonical[2:])
        check = next(d for d in "0123456789" if _luhn(body + d))
        return body + (check if _luhn(canonical) else str((int(check) + 1 + rng.below(9)) % 10))
    if kind == "phone":
        code = len(re.sub(r"\D", "", form))
        code = code if code < len(canonical) - 6 else 1 if form else 0
        low = 2 if attempt < 4 * WIDER else 0
        return canonical[:code] + "".join(str(low + rng.below(10 - low) if i == 0 else rng.below(10)) for i in range(len(canonical) - code))
    words = canonical.split(" ")
    kind_of = script(canonical)
    given = _GIVEN[kind_of, form or "m"].split()
    syllables = _SYLLABLES[kind_of].split()
    out = [given[rng.below(len(given))]] if len(words) > 1 else []
    for _ in words[len(out) :]:
        made = "".join(syllables[rng.below(len(syllables))] for _ in range(3 + rng.below(2) + attempt // WIDER))
        out.append((made + _ENDING.get((kind_of, form), "")).capitalize())
    return " ".join(out).casefold()


def dressed(kind: str, original: str, new: str) -> str:
    """``new`` with the separators and the case of ``original``."""
    if kind in ("card", "phone"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in original)
    if kind == "email":
        return new.upper() if original.isupper() else new
    if kind == "name":
        gap = " " if " " in original else " "
        return gap.join(w.upper() if original.isupper() else w.capitalize() for w in new.split(" "))
    return new


_FIELDS = ("kind", "canonical", "start", "end", "form", "part")
_NUMBERS = ("start", "end", "part")
ENTITIES = ArrayType(StructType([StructField(f, IntegerType() if f in _NUMBERS else StringType()) for f in _FIELDS]))
_ARROW = pa.list_(pa.struct([(f, pa.int32() if f in _NUMBERS else pa.string()) for f in _FIELDS]))


def with_entities(df: DataFrame, text: str = "text", entities: str = "entities") -> DataFrame:
    """``df`` with ``entities``: kind, canonical form, start and end in code points, form."""

    def compute(column: pa.Array) -> list[pa.Array]:
        return [pa.array([[dict(zip(_FIELDS, e)) for e in find(t)] if t else [] for t in column.to_pylist()], _ARROW)]

    return add_columns(df, [text], [(entities, ENTITIES)], compute)


def settle(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, form, attempt, surrogate) of distinct entities, without collisions.

    Every round looks for equal surrogates and for surrogates that are entities; of equal
    ones the least entity keeps its attempt.
    """

    def compute(kind: pa.Array, canonical: pa.Array, form: pa.Array, attempt: pa.Array) -> list[pa.Array]:
        rows = zip(kind.to_pylist(), canonical.to_pylist(), attempt.to_pylist(), form.to_pylist())
        return [pa.array([surrogate(key, *row) for row in rows], pa.string())]

    def named(df: DataFrame) -> DataFrame:
        return add_columns(df, ["kind", "canonical", "form", "attempt"], [("surrogate", StringType())], compute)

    # an entity's gender is the one of its first form, so that all its mentions agree
    every = staged(entities.groupBy("kind", "canonical").agg(F.min("form").alias("form")), "entities")
    current = staged(named(every.withColumn("attempt", F.lit(0))), "surrogates")
    for _ in range(MOST_ROUNDS):
        winner = current.groupBy("kind", "surrogate").agg(F.min("canonical").alias("winner"))
        real = every.select("kind", F.col("canonical").alias("surrogate"), F.lit(True).alias("real"))
        judged = current.join(winner, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        lost = F.coalesce("real", F.lit(False)) | (F.col("winner") != F.col("canonical"))
        judged = judged.select("kind", "canonical", "form", (F.col("attempt") + lost.cast("int")).alias("attempt"), lost.alias("lost"))
        judged = staged(judged, "judged")
        if judged.where("lost").isEmpty():
            return current
        current = staged(named(judged.drop("lost")), "surrogates")
    raise ValueError(f"after {MOST_ROUNDS} rounds some entities still have no surrogate of their own")


def replace(df: DataFrame, key: bytes, id_col: str = "doc_id", text: str = "text", entities: str = "entities") -> DataFrame:
    """``df`` with every entity of ``text`` replaced; ``entities`` has kind, start and end of the replacements."""
    found = with_entities(df, text, entities)
    each = found.where(F.size(entities) > 0).select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__hash"), F.explode(entities).alias("e"))
    settled = settle(each.select("e.kind", "e.canonical", "e.form"), key)
    special = settled.where("attempt > 0 OR form != ''").select("kind", "canonical", "form", "attempt")
    spoken = each.select("__id", "__hash", "e.kind", "e.canonical").distinct().join(special, ["kind", "canonical"])
    by_text = spoken.groupBy("__id", "__hash").agg(F.collect_list(F.struct("kind", "canonical", "form", "attempt")).alias("__special"))
    with_data = found.where(F.size(entities) > 0).withColumns({"__key": F.col(id_col), "__text_hash": F.xxhash64(text)})
    by_text = by_text.withColumnsRenamed({"__id": "__key", "__hash": "__text_hash"})
    met = with_data.join(by_text.hint("merge"), (with_data["__key"].eqNullSafe(by_text["__key"])) & (with_data["__text_hash"] == by_text["__text_hash"]), "left")
    met = met.drop("__key", "__text_hash")

    def compute(texts: pa.Array, spans: pa.Array, specials: pa.Array) -> list[pa.Array]:
        new_texts, new_spans = [], []
        for body, own, special in zip(texts.to_pylist(), spans.to_pylist(), specials.to_pylist()):
            known = {(s["kind"], s["canonical"]): (s["attempt"], s["form"]) for s in special or ()}
            parts, last, at, made = [], 0, 0, []
            for e in own:
                attempt, form = known.get((e["kind"], e["canonical"]), (0, e["form"]))
                whole = surrogate(key, e["kind"], e["canonical"], attempt, form)
                new = dressed(e["kind"], body[e["start"] : e["end"]], whole if e["part"] < 0 else whole.split(" ")[e["part"]])
                parts += [body[last : e["start"]], new]
                at += e["start"] - last
                made.append({"kind": e["kind"], "start": at, "end": at + len(new)})
                at += len(new)
                last = e["end"]
            parts.append(body[last:])
            new_texts.append("".join(parts))
            new_spans.append(made)
        return [pa.array(new_texts, pa.string()), pa.array(new_spans, _ARROW_SPANS)]

    rewritten = add_columns(met, [text, entities, "__special"], [(text, StringType()), (entities, SPANS)], compute).drop("__special")
    untouched = found.where(F.size(entities) == 0).withColumn(entities, F.array().cast(SPANS))
    return rewritten.select(*untouched.columns).union(untouched)


SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
