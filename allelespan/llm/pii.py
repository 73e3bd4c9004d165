"""PII surrogates: detected entities get keyed replacements of their own type, gender, script and format.

Detection: e-mail addresses, telephone numbers, payment cards (Luhn), IBANs (their check digits), social security numbers, IPv4
and IPv6 addresses, credentials (access keys, quoted tokens, passwords) and person names that stand after a form of address. An
entity's canonical form (digits of a number, lower-case address, gender and lower-case name without its form of address) names
it in the whole corpus, so one entity has one surrogate wherever and however it is written (coreference). A name without gender
(Dr, Prof) is the person of that name whose gender is known, if the corpus has it with one gender only. Family names are entities
of their own: all who bear one get the same other one, so `Mr John Smith`, `Mr Smith` and `Ms Anna Smith` still belong together.

The surrogate is made from a keyed BLAKE2 hash of type, canonical form and attempt; it fills the entity's own format (digits for
digits, letters for letters in their case and script, check digits right, octets in range, given names of the same gender and
script). Two entities with one surrogate as written, or a surrogate written like an entity of the corpus, are found by a group-by
over all distinct entities; all but the first try the next attempt, until none is left. Later attempts give up format for
room (other characters of a password become letters, then all of them; an address gets a longer local part; a foreign number
another country code; names get a second part, then a made-up one), so entities with few or no characters to fill find a free
one. Only entities past attempt 0, and names that take another's form, are kept, for use when texts are rewritten.

The key is the caller's: who knows it can search for what a surrogate was made from, so it must be secret. The registered query and
the pipeline take it from the session (`spark.allelespan.pii.key`); only where that is unset do they use a public one, so that
their rows can be compared.

Both passes are over rows; only distinct entities are shuffled. The exceptions are broadcast while there are at most
EXCEPTIONS of them; beyond that they are joined to the mentions and the texts are rewritten through that join.

Edge cases: null stays null with 0 entities; empty texts and texts without entities come back as they are, byte for byte.
Overlapping finds go to the one that starts first, then the longer. A run of digits that is
no card is searched for one between the borders of its groups. Repeated rows get equal texts. Extra columns are
carried; a column n_entities is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from ipaddress import IPv6Address

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allelespan.llm._common import free_name, staged, table

#: For comparable rows of the registered query only; see above.
PUBLIC_KEY = "public-1"
EXCEPTIONS = 1_000_000
#: Attempts after this one give up more of the format.
FORMAT = 8
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Given names by gender and script, family names by script, forms of address by gender.
GIVEN = {
    ("f", "latin"): "Alice Beatrix Clara Dorothea Edith Florence Gloria Harriet Ingrid Judith Katharina Lucille Margaret Nadine Ophelia Patricia Rosalind Sophia Theresa Ursula Veronica Wilhelmina Yvonne Zelda".split(),
    ("m", "latin"): "Albert Bernard Charles Dominic Edward Frederick Gregory Harold Isidore Joseph Klaus Leonard Maurice Norbert Oswald Philip Quentin Raymond Sebastian Thomas Ulrich Victor Walter Xavier".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Ирина Ксения Лариса Мария Надежда Ольга Полина Раиса Светлана Тамара".split(),
    ("m", "cyrillic"): "Андрей Борис Виктор Геннадий Дмитрий Евгений Игорь Кирилл Леонид Михаил Николай Олег Павел Роман Сергей Юрий".split(),
}
FAMILY = {
    "latin": "Abernathy Blackwood Carmichael Delacroix Eisenhart Fairbanks Goldstein Hawthorne Ivanhoe Jefferson Kirkland Lindqvist Montague Nightingale Oppenheim Pemberton Quimby Rosenthal Sutherland Templeton Underwood Vandermeer Whitfield Yarborough".split(),
    "cyrillic": "Авдеенко Белых Гончаренко Долгих Живаго Иваненко Коваленко Лысенко Макаренко Нестеренко Остапенко Петренко Рябых Седых Тимошенко Шевченко".split(),
}
ADDRESS = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Señor": "m", "Señora": "f", "г-н": "m", "г-жа": "f", "Dr": "", "Prof": ""}

_TITLES = ADDRESS | {a.upper(): g for a, g in ADDRESS.items()}

_UP, _LOW = "[A-ZÀ-ÖØ-ÞА-ЯЁ]", "[a-zà-öø-ÿа-яё]"
#: Müller, McDonald, O'Brien; or all in capitals.
_PLAIN = rf"(?:{_UP}['’])?{_UP}{_LOW}+(?:{_UP}{_LOW}+)*"
_NAME = rf"{_PLAIN}(?:-{_PLAIN})*"
_LOUD = rf"(?:{_UP}['’])?{_UP}{{2,}}(?:-{_UP}{{2,}})*(?!\w)"
#: Small words inside family names.
_SMALL_WORDS = "van von de den der del della di da dos la le ter zu bin ibn".split()
_SMALL = f"(?: (?:{'|'.join(_SMALL_WORDS)}))*"
_KINDS = [
    ("email", r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w@])"),
    ("access_key", r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("token", r"(?<=(?i:token = \"))[0-9A-Fa-f]{40}(?=\")"),
    ("password", r"(?<=(?:password|PASSWORD|Password)=)[^\s\"'#$%&*|!,;]{5,}[^\s\"'#$%&*|!,;.]"),
    ("ip", r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w)"),
    ("ipv6", r"(?<![\w:.])(?=[0-9A-Fa-f]*:[0-9A-Fa-f]*:)[0-9A-Fa-f:]{4,38}[0-9A-Fa-f](?![\w:])"),
    ("iban", r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    ("ssn", r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])"),
    ("phone", r"(?:(?<=[Pp]hone )|(?<=[Pp]hone: )|(?<=[Tt]el )|(?<=[Tt]el: )|(?<=[Tt]el\. )|(?<=[Ff]ax )|(?<=[Ff]ax: ))\d{10}(?!\w)"),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)"),
    ("phone", r"(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)"),
    ("card", r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    ("name", rf"(?<!\w)(?:{'|'.join(_TITLES)})\.? (?:{_NAME}(?:{_SMALL} {_NAME}){{0,2}}|{_LOUD}(?: {_LOUD}){{0,2}})"),
]
FIND = re.compile("|".join(f"(?P<k{i}>{p})" for i, (_, p) in enumerate(_KINDS)))


def maybe(text: Column) -> Column:
    """Cheap test on the JVM: a text for which it is false has no entity. The first part decides most; null for null."""
    found = text.rlike("[0-9@]")
    marks = {a for a in _TITLES if not any(a != b and b in a for b in _TITLES)}  # Mr stands in Mrs too
    for mark in ("AKIA", "password=", "PASSWORD=", "Password=", *sorted(marks)):
        found = found | text.contains(mark)
    return found


def luhn(digits: str) -> int:
    """What is wrong with the last digit: 0 for a right number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10


def _iban_rest(iban: str) -> int:
    """1 for a right one."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _card_in(found: str) -> tuple[int, int] | None:
    """Start and end of the first, then longest, run of whole groups of digits in `found` that is a card."""
    groups = [m.span() for m in re.finditer(r"\d+", found)]
    for i, (a, _) in enumerate(groups):
        for _, b in reversed(groups[i:]):
            digits = re.sub(r"\D", "", found[a:b])
            if 13 <= len(digits) <= 19 and luhn(digits) == 0:
                return a, b
    return None


def find(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of each entity."""
    at = 0
    while m := FIND.search(text, at):
        at = m.end()
        kind, found = _KINDS[int(m.lastgroup[1:])][0], m[0]
        if kind == "email":
            canon = found.lower()
        elif kind in ("phone", "card"):
            canon = re.sub(r"\D", "", found)
            if kind == "card" and luhn(canon):  # other numbers beside it, or no card
                inner = _card_in(found)
                if inner is None:
                    at = m.start() + re.match(r"\d+", found).end()  # the next group may begin an entity
                    continue
                a, b = m.start() + inner[0], m.start() + inner[1]
                at = b
                yield a, b, kind, re.sub(r"\D", "", text[a:b])
                continue
            if kind == "phone":
                if not 8 <= len(canon) <= 15:
                    continue
                if canon[0] == "1" and len(canon) == 11:  # a ten-digit number is the same with its country code
                    canon = canon[1:]
                elif found[0] == "+":
                    canon = "+" + canon
        elif kind == "ip":
            canon = ".".join(str(int(x)) for x in found.split("."))
        elif kind == "ipv6":
            try:
                canon = str(IPv6Address(found))
            except ValueError:
                at = m.start() + re.match("[0-9A-Fa-f]*:*", found).end()
                continue
        elif kind == "iban":
            canon = found.replace(" ", "")
            if _iban_rest(canon) != 1:
                at = m.start() + 4
                continue
        elif kind == "name":
            title, _, rest = found.partition(" ")
            canon = _TITLES[title.rstrip(".")] + "|" + rest.lower().replace("’", "'")
            yield m.start() + len(title) + 1, m.end(), kind, canon
            continue
        else:
            canon = found
        yield m.start(), m.end(), kind, canon


def family_of(canon: str) -> str:
    """The family name of a canonical name."""
    return canon.partition("|")[2].rpartition(" ")[2]


def keys_of(text: str) -> set[tuple[str, str]]:
    """Type and canonical form of each entity and of each family."""
    found = {(kind, canon) for _, _, kind, canon in find(text)}
    return found | {("family", family_of(canon)) for kind, canon in found if kind == "name"}


class _Stream:
    """Keyed numbers."""

    def __init__(self, key: str, kind: str, canon: str, attempt: int):
        self.seed, self.n, self.left = f"{kind}\0{canon}\0{attempt}".encode("utf-8", "surrogatepass"), 0, b""
        self.key = blake2b(key.encode(), digest_size=32).digest()

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left = blake2b(self.seed + self.n.to_bytes(4, "big"), key=self.key, digest_size=64).digest()
            self.n += 1
        x, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return x % n


def _letters(s: _Stream, n: int) -> str:
    return "".join(LETTERS[s.below(52)] for _ in range(n))


def _like(s: _Stream, text: str, hexed: bool = False, every: bool = False) -> str:
    """Digits for digits, letters for letters in their case and script, Latin letters for those of other scripts and, with `every`, for all else."""
    out = []
    for c in text:
        if hexed and c in "0123456789abcdef":
            out.append("0123456789abcdef"[s.below(16)])
        elif hexed and c in "ABCDEF":
            out.append("ABCDEF"[s.below(6)])
        elif "0" <= c <= "9":
            out.append(str(s.below(10)))
        elif "a" <= c <= "z":
            out.append(chr(97 + s.below(26)))
        elif "A" <= c <= "Z":
            out.append(chr(65 + s.below(26)))
        elif "а" <= c <= "я":
            out.append(chr(0x430 + s.below(32)))
        elif "А" <= c <= "Я":
            out.append(chr(0x410 + s.below(32)))
        else:
            out.append(_letters(s, 1) if every or c.isalnum() else c)
    return "".join(out)


def _script(name: str) -> str:
    return "cyrillic" if re.search("[А-Яа-яЁё]", name) else "latin"


def _made_up(s: _Stream, script: str) -> str:
    return "".join(chr((0x430 if script == "cyrillic" else 97) + s.below(26)) for _ in range(8)).title()


def surrogate(kind: str, canon: str, attempt: int, key: str, family: str | None = None) -> str:
    """The canonical form of the surrogate; of a name with the family name that its family gets (its first, if not given)."""
    s = _Stream(key, kind, canon, attempt)
    if kind == "email":
        local, _, domain = canon.partition("@")
        name, dot, top = domain.rpartition(".")
        more = _letters(s, 8).lower() if attempt > FORMAT else ""
        return f"{_like(s, local)}{more}@{_like(s, name)}{dot}{top}"
    if kind == "card":
        body = canon[0] + _like(s, canon[1:-1])
        return body + str((10 - luhn(body + "0")) % 10)
    if kind == "phone":
        if len(canon) == 10 and canon[0] != "+":
            return "".join(str(2 + s.below(8)) + _like(s, "00") for _ in range(2)) + _like(s, "0000")
        kept = 2 + (canon[0] == "+")
        if attempt > FORMAT:  # not 1: that is the code of ten-digit numbers
            return "+" * (kept - 2) + str(2 + s.below(8)) + _like(s, canon[kept - 1 :])
        return canon[:kept] + _like(s, canon[kept:])
    if kind == "ip":
        return ".".join(str((1 + s.below(223)) if i == 0 else s.below(256)) for i in range(4))
    if kind == "access_key":
        return "AKIA" + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"[s.below(36)] for _ in canon[4:])
    if kind == "token":
        return _like(s, canon, hexed=True)
    if kind == "password":
        if attempt > FORMAT:
            return _letters(s, len(canon))
        return _like(s, canon, hexed=re.fullmatch("[0-9a-f]+|[0-9A-F]+", canon) is not None, every=attempt > 0)
    if kind == "ipv6":
        return ":".join(f"{s.below(65536):x}" for _ in range(8))
    if kind == "ssn":
        return f"{100 + s.below(566):03d}-{1 + s.below(99):02d}-{1 + s.below(9999):04d}"
    if kind == "iban":
        body = canon[:2] + "00" + _like(s, canon[4:])
        return f"{body[:2]}{98 - _iban_rest(body):02d}{body[4:]}"
    if kind == "family":
        script = _script(canon)
        made = FAMILY[script][s.below(len(FAMILY[script]))]
        if attempt:  # few names, many families: a second part
            made += "-" + FAMILY[script][s.below(len(FAMILY[script]))]
        return made + ("-" + _made_up(s, script) if attempt > FORMAT else "")
    gender, _, name = canon.partition("|")
    parts, script = name.split(" "), _script(name)
    last = surrogate("family", parts[-1], 0, key) if family is None else family
    given = GIVEN[(gender or "fm"[s.below(2)], script)]
    made = [given[s.below(len(given))] if x not in _SMALL_WORDS else x for x in parts[:-1]]
    if attempt and made:
        made[0] += "-" + given[s.below(len(given))]
    if attempt > FORMAT and made:
        made[0] += "-" + _made_up(s, script)
    return gender + "|" + " ".join([*made, last])


def rendered(kind: str, found: str, made: str) -> str:
    """The surrogate in the format of the mention."""
    if kind in ("phone", "card"):
        made = made.lstrip("+")
        own = re.sub(r"\D", "", found)
        digits = iter(own[: len(own) - len(made)] + made)
        return re.sub(r"\d", lambda _: next(digits), found)
    if kind == "name":
        made = made.partition("|")[2]
        return made.upper() if len(found) > 1 and found.isupper() else made
    if kind == "iban":
        rest = iter(made)
        return "".join(c if c == " " else next(rest) for c in found)
    if kind == "email" and found != found.lower():
        return "".join(b.upper() if a.isupper() else b for a, b in zip(found.ljust(len(made)), made))
    return made


def rewrite(text: str, attempts: dict[tuple[str, str], tuple[str, int]], key: str) -> tuple[str, int]:
    """attempts: the canonical form to use and the attempt, of the entities that exceptions() has."""
    out, at, n = [], 0, 0
    for a, b, kind, canon in find(text):
        own, attempt = attempts.get((kind, canon), (canon, 0))
        family = None
        if kind == "name":
            family = surrogate("family", family_of(own), attempts.get(("family", family_of(own)), ("", 0))[1], key)
        out += [text[at:a], rendered(kind, text[a:b], surrogate(kind, own, attempt, key, family))]
        at, n = b, n + 1
    return ("".join(out) + text[at:], n) if n else (text, 0)


def entities(df: DataFrame, text: str) -> DataFrame:
    """kind, canon: distinct entities and families of all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = {x for t in pdf["t"] for x in keys_of(t)}
            yield pd.DataFrame(list(found), columns=["kind", "canon"])

    return df.select(F.col(text).alias("t")).where(maybe(F.col("t"))).mapInPandas(run, "kind string, canon string").distinct()


def _written(form: str) -> Column:
    """What of a canonical form stands in texts, case aside: names go without gender."""
    return F.when(F.col("kind") == "name", F.lower(F.substring_index(form, "|", -1))).when(F.col("kind") == "family", F.lower(form)).otherwise(F.col(form))


def persons(found: DataFrame) -> DataFrame:
    """kind, canon, own: own is canon, but for a name without gender that is found with one gender only, which it takes."""
    named = found.where("kind = 'name' AND canon NOT LIKE '|%'").groupBy(F.concat(F.lit("|"), F.substring_index("canon", "|", -1)).alias("canon"))
    one = named.agg(F.min("canon").alias("_own"), F.count("*").alias("n")).where("n = 1").select(F.lit("name").alias("kind"), "canon", "_own")
    return found.select("kind", "canon").join(one, ["kind", "canon"], "left").select("kind", "canon", F.coalesce("_own", "canon").alias("own"))


def exceptions(found: DataFrame, key: str, most: int = 64) -> DataFrame:
    """kind, canon, own, attempt: the entities whose first surrogate was taken, or that take another's form. found: distinct entities
    and their families, staged. Families come first, as names are written with theirs. A name of one word is written as its
    family is, so it needs no attempts."""
    people = staged(persons(found), "pii-persons")
    real = people.select("kind", _written("own").alias("made"))
    first = people.where("kind <> 'name'").select("kind", "own", F.lit(None).cast("string").alias("family"))
    settled = _settled(first.distinct(), real, key, most)
    families = settled.where("kind = 'family'").select(F.col("own").alias("last"), F.col("made_as").alias("family"))
    names = people.where("kind = 'name' AND instr(own, ' ') > 0").select("kind", "own").distinct()
    names = names.withColumn("last", F.substring_index(F.substring_index("own", "|", -1), " ", -1)).join(families, "last").select("kind", "own", "family")
    both = settled.select("kind", "own", "attempt").unionByName(_settled(names, real, key, most).select("kind", "own", "attempt"))
    # names of one word have no attempt of their own
    out = people.join(both, ["kind", "own"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
    return out.where("attempt > 0 OR own <> canon").select("kind", "canon", "own", "attempt")


def _settled(first: DataFrame, real: DataFrame, key: str, most: int) -> DataFrame:
    """first: kind, own, family (of names); real: kind, made. kind, own, family, attempt, made (as compared) and made_as (as written):
    no two of a kind are alike, nor like one of real."""

    @F.pandas_udf("string")
    def made(kind: pd.Series, own: pd.Series, attempt: pd.Series, family: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, c, int(a), key, f) for k, c, a, f in zip(kind, own, attempt, family)], dtype=object)

    def attempted(df: DataFrame) -> DataFrame:
        return df.withColumn("made_as", made("kind", "own", "attempt", "family")).withColumn("made", _written("made_as"))

    now = staged(attempted(first.withColumn("attempt", F.lit(0))), "pii-surrogates")
    for _ in range(most):
        # a real entity owns its own form; among surrogates the earliest attempt, then the smallest form, stays
        taken = now.join(real, ["kind", "made"], "left_semi").select("kind", "own")
        shared = now.groupBy("kind", "made").agg(F.min(F.struct("attempt", "own")).alias("stays"), F.count("*").alias("n")).where("n > 1")
        late = now.join(shared.select("kind", "made", "stays"), ["kind", "made"]).where("own <> stays.own").select("kind", "own")
        again = staged(taken.union(late).distinct(), "pii-again")
        if again.isEmpty():
            return now
        moved = attempted(now.join(again, ["kind", "own"], "left_semi").select("kind", "own", "family", (F.col("attempt") + 1).alias("attempt")))
        now = staged(now.join(again, ["kind", "own"], "left_anti").unionByName(moved), "pii-surrogates")
    raise RuntimeError(f"surrogates still collide after {most} attempts")


def replaced(df: DataFrame, key: str, text: str = "text", bound: int = EXCEPTIONS) -> DataFrame:
    """The rows with surrogates in text, and n_entities."""
    df = df.drop("n_entities")
    odd = staged(exceptions(staged(entities(df, text), "pii-entities"), key), "pii-exceptions")
    many = odd.count() > bound
    out = T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.LongType())])
    if not many:
        attempts = df.sparkSession.sparkContext.broadcast({(r.kind, r.canon): (r.own, r.attempt) for r in odd.collect()})

        @F.pandas_udf(out)
        def rewritten(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([(None, 0) if t is None else rewrite(t, attempts.value, key) for t in texts], columns=["text", "n"])

        # only texts that may have entities go to Python; all come from one scan
        r = free_name(df, "_r")
        got = df.withColumn(r, rewritten(F.when(maybe(F.col(text)), F.col(text))))
        return got.withColumns({text: F.coalesce(F.col(r)["text"], F.col(text)), "n_entities": F.coalesce(F.col(r)["n"], F.lit(0).cast("long"))}).drop(r)

    @F.pandas_udf("array<struct<kind:string,canon:string>>")
    def mentioned(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "canon": c} for k, c in keys_of(t or "")] for t in texts])

    @F.pandas_udf(out)
    def through(texts: pd.Series, own: pd.Series) -> pd.DataFrame:
        got = [(t, 0) if t is None else rewrite(t, {(x["kind"], x["canon"]): (x["own"], x["attempt"]) for x in (o if o is not None else [])}, key) for t, o in zip(texts, own)]
        return pd.DataFrame(got, columns=["text", "n"])

    row, own, r = (free_name(df, x) for x in ("_row", "_own", "_r"))
    rows = staged(df.withColumn(row, F.monotonically_increasing_id()), "pii-rows")
    mentions = rows.select(F.col(row).alias("row"), F.explode(mentioned(text)).alias("m")).select("row", "m.kind", "m.canon").join(odd, ["kind", "canon"])
    held = mentions.groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("kind", "canon", "own", "attempt")).alias(own))
    got = rows.join(held, row, "left").withColumn(r, through(text, own))
    return got.withColumns({text: F.col(r)["text"], "n_entities": F.col(r)["n"]}).drop(r, own, row)


def key_of(spark: SparkSession) -> str:
    return spark.conf.get("spark.allelespan.pii.key", PUBLIC_KEY)


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), key_of(spark))


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; n_chars, where there is one, follows the new text."""
    own = free_name(docs, "_own_entities")
    out = replaced(docs.withColumnRenamed("n_entities", own), key_of(spark))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop("n_entities").withColumnRenamed(own, "n_entities").select(docs.columns)
