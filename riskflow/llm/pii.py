"""Replacing personal data by surrogates, in DataFrame expressions only.

Entities are found by one pattern. Each distinct entity (type and normalised value, over the
whole table) gets one surrogate drawn from a keyed hash: the same person, number or address reads
the same wherever it occurs, a surrogate has its entity's type, gender, script and format,
no two entities share one, and none equals an entity of the table. Entities that collide draw again
until none does; from the third time on each draw is a character longer, so a pool never runs out.

* types: mail address, phone, payment card, IPv4 address, social security number, secret, and names
  after a title (given names by the title's gender; a surname alone is the surname of full names);
* a name found after a title is replaced wherever its document has it as a capitalised word, before
  or after, with or without a title; other names are not detected;
* null text stays null, text without an entity stays as it is; a repeated row gets the same result;
* an entity that any share of all texts holds is one row of the surrogate table; the join is on two
  fresh exchanges, so adaptive execution can split it;
* an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.common import kept_table, packed

# Titles by gender, given names by gender and script, syllables of surnames by script.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Señorita", "Госпожа", "Κυρία")
GIVEN = {
    "m_latin": ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Jonas", "Lucas", "Martin", "Oscar", "Paul", "Simon", "Thomas", "Victor", "Walter"),
    "f_latin": ("Alice", "Bianca", "Clara", "Diana", "Emma", "Flora", "Helen", "Irene", "Julia", "Laura", "Marta", "Nina", "Olivia", "Paula", "Sofia", "Vera"),
    "m_cyrillic": ("Андрей", "Борис", "Виктор", "Глеб", "Денис", "Иван", "Максим", "Павел"),
    "f_cyrillic": ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга"),
    "m_greek": ("Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Παύλος", "Σταύρος"),
    "f_greek": ("Άννα", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία", "Χριστίνα"),
}
SYLLABLES = {
    "latin": ("bar", "cor", "del", "fen", "gar", "hol", "kel", "lan", "mer", "nor", "pel", "ros", "sal", "tor", "val", "wen"),
    "cyrillic": ("бар", "вол", "гор", "дон", "зан", "кор", "лев", "мар", "нов", "пет", "ром", "сар", "тим", "фед", "чер", "шев"),
    "greek": ("αλ", "βασ", "γερ", "δημ", "ευθ", "καλ", "λαμ", "μαρ", "νικ", "παπ", "ραλ", "σαρ", "τσι", "φωτ", "χατ", "ψαρ"),
}

_TITLE = rf"(?:{'|'.join(MALE + FEMALE)})\.?"
#: A possessive s is not part of a name. Possessive quantifiers keep long words off the matcher's stack.
_NAME = r"\p{Lu}(?:\p{L}++|(?=['’-]\p{L}{2}))(?:['’-](?!s(?!\p{L}))\p{L}++)*+"
_LABEL = r"""(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)(?:[_-]key)?["']?\s{0,3}[=:]\s{0,3}["']?"""
#: A run of dashes, lines or slashes alone is a rule or a blank to fill in, not a secret.
_VALUE = r"(?=[+/_-]*[A-Za-z0-9])[A-Za-z0-9+/_-]{12,}"
WORDS = {
    "mail": r"(?<![0-9._+-])[\p{L}0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "person": rf"{_TITLE} {_NAME}(?: {_NAME})?",
    "secret": rf"(?:{_LABEL}{_VALUE}|AKIA[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{30,}}|sk-[A-Za-z0-9]{{20,}})",
}
NUMBERS = {
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<!\d)(?:\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}|\d{15,16})(?!\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
}
#: All types at once. Words are tried where a word starts, numbers where one may start.
PATTERN = rf"(?<!\p{{L}})(?:{'|'.join(WORDS.values())})|(?=[0-9+(])(?:{'|'.join(NUMBERS.values())})"

#: A capitalised word between entities.
CAPITAL = rf"(?<![\p{{L}}\p{{N}}_]){_NAME}(?!\p{{L}})"


def _sql(text: str) -> str:
    return "r'" + text.replace("'", "\\x27") + "'" if "'" in text else f"r'{text}'"


KINDS = ("mail", "secret", "ip", "phone", "ssn", "card", "given_m", "given_f", "surname")


def _array(values: tuple[str, ...]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _kind(mention: str) -> str:
    """Type of a match, told from the match alone."""
    tests = [f"when {mention} rlike {_sql(f'^(?:{p})$')} then '{t}'" for t, p in {"person": WORDS["person"], "mail": WORDS["mail"], **NUMBERS}.items()]
    return f"case {' '.join(tests)} else 'secret' end"


def _parts() -> str:
    """Array of (before, kind, raw) for the lambda variable ``m`` and the text ``piece`` before it."""
    title = rf"regexp_extract(m, {_sql(f'^{_TITLE} ')}, 0)"
    rest = f"substring(m, length({title}) + 1)"
    gender = f"if({title} rlike {_sql('^(?:' + '|'.join(MALE) + ')[.]? ')}, 'given_m', 'given_f')"
    person = (
        f"if(locate(' ', {rest}) > 0, array(struct(concat(piece, {title}) as before, {gender} as kind, substring_index({rest}, ' ', 1) as raw),"
        f" struct(' ' as before, 'surname' as kind, substring_index({rest}, ' ', -1) as raw)), array(struct(concat(piece, {title}) as before, 'surname' as kind, {rest} as raw)))"
    )
    label = f"regexp_extract(m, {_sql(f'^{_LABEL}')}, 0)"
    secret = f"array(struct(concat(piece, {label}) as before, 'secret' as kind, substring(m, length({label}) + 1) as raw))"
    return f"case {_kind('m')} when 'person' then {person} when 'secret' then {secret} else array(struct(piece as before, {_kind('m')} as kind, m as raw)) end"


def text_parts(text: Column) -> Column:
    """Entities of a text in order, each with the text since the last one."""
    pieces, mentions = F.split(text, PATTERN, -1), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    return F.struct(pieces.alias("pieces"), mentions.alias("mentions"))


def _normal(kind: str = "kind", raw: str = "raw") -> str:
    digits = f"regexp_replace({raw}, '[^0-9]', '')"
    return f"case when {kind} in ('phone') then right({digits}, 10) when {kind} in ('card', 'ssn') then {digits} when {kind} in ('secret', 'ip') then {raw} else lower({raw}) end"


def _stream() -> str:
    """512 hex digits drawn by key, type, value and attempt: HMAC-SHA-512 with the pads of the key as columns."""
    told = "encode(concat_ws('|', kind, norm, attempt, '{i}'), 'utf-8')"
    inner = f"unhex(sha2(concat(inner_pad, {told}), 512))"
    return "concat(" + ", ".join(f"sha2(concat(outer_pad, {inner}), 512)".replace("{i}", str(i)) for i in range(4)) + ")"


def _key_table(spark: SparkSession, key: str) -> DataFrame:
    """The padded key per kind of entity, a local table of the JVM. As rows it is in no expression, so in no plan or event log."""
    data = key.encode()
    block = (hashlib.sha512(data).digest() if len(data) > 128 else data).ljust(128, b"\0")
    pads = [bytes(b ^ mask for b in block) for mask in (0x36, 0x5C)]
    return spark.createDataFrame(pa.table({"kind": KINDS, "inner_pad": [pads[0]] * len(KINDS), "outer_pad": [pads[1]] * len(KINDS)}))


def _at(i: str) -> str:
    return f"cast(conv(substring(stream, 1 + 3 * pmod({i}, 170), 3), 16, 10) as int)"


def _candidate() -> str:
    """The surrogate of (kind, norm, attempt), from ``stream``."""
    pick = lambda letters, i: f"substring('{letters}', 1 + pmod({_at(i)}, {len(letters)}), 1)"
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    char = "substring(norm, i, 1)"
    mixed = f"case when {char} rlike '[0-9]' then {pick(digits, 'i')} when {char} rlike '[a-z]' then {pick(lower, 'i')} when {char} rlike '[A-Z]' then {pick(lower.upper(), 'i')} when {char} rlike r'\\p{{L}}' then {pick(lower, 'i')} else {char} end"
    hexed = f"case when {char} rlike '[0-9a-f]' then {pick('0123456789abcdef', 'i')} else {char} end"
    each = lambda body, upto="length(norm)": f"array_join(transform(sequence(1, {upto}), i -> {body}), '')"
    # Later attempts add digits, one more each time: behind a value, before the local part of a mail address.
    # The last label of an address is kept.
    more = "greatest(attempt - 2, 0)"
    tail = f"if(attempt > 2, {each(pick(digits, '149 + i'), 'attempt - 2')}, '')"
    kept = "length(substring_index(norm, '.', -1)) + 1"
    mail = f"concat(if(attempt > 2, {each(pick(digits, '159 + i'), 'attempt')}, ''), {each(mixed, f'length(norm) - ({kept})')}, right(norm, {kept}))"
    secret = f"concat(if(norm rlike '^[0-9a-f]+$', {each(hexed)}, {each(mixed)}), {tail})"
    # There are no more than four parts; what is added reads as a port.
    ip = f"concat(array_join(transform(sequence(1, 4), i -> cast(1 + pmod({_at('i')}, 254) as string)), '.'), if(attempt > 2, concat(':', {tail}), ''))"
    number = each(f"if(i = 1, cast(2 + pmod({_at('1')}, 8) as string), {pick(digits, 'i')})", f"length(norm) + {more}")
    ssn = each(f"if(i = 1, cast(1 + pmod({_at('1')}, 5) as string), {pick(digits, 'i')})", f"length(norm) + {more}")
    body = each(f"if(i = 1, left(norm, 1), {pick(digits, 'i')})", f"length(norm) - 1 + {more}")
    # Check digit: from the right, every second digit of the body starting with its last is doubled.
    doubled = "2 * cast(substring(c, i, 1) as int)"
    luhn = f"transform(array({body}), c -> concat(c, cast(pmod(10 - pmod(aggregate(sequence(1, length(c)), 0, (s, i) -> s + if(pmod(length(c) - i, 2) = 0, {doubled} - if({doubled} > 9, 9, 0), cast(substring(c, i, 1) as int))), 10), 10) as string)))[0]"
    script = "case when norm rlike r'^\\p{IsCyrillic}' then 'cyrillic' when norm rlike r'^\\p{IsGreek}' then 'greek' else 'latin' end"
    syllable = lambda name: f"array_join(transform(sequence(1, 2 + attempt), i -> element_at({_array(SYLLABLES[name])}, 1 + pmod({_at('20 + i')}, {len(SYLLABLES[name])}))), '')"
    surname = f"case {script} " + " ".join(f"when '{s}' then {syllable(s)}" for s in SYLLABLES) + " end"

    def given(gender: str) -> str:
        # Later attempts join a second syllable, since the list of names is finite.
        options = []
        for name in SYLLABLES:
            first = f"lower(element_at({_array(GIVEN[f'{gender}_{name}'])}, 1 + pmod({_at('9')}, {len(GIVEN[f'{gender}_{name}'])})))"
            options.append(f"when '{name}' then concat({first}, if(attempt > 0, concat('-', lower({syllable(name)})), ''))")
        return f"case {script} {' '.join(options)} end"

    kinds = {"mail": mail, "secret": secret, "ip": ip, "phone": number, "ssn": ssn, "card": luhn, "given_m": given("m"), "given_f": given("f"), "surname": surname}
    return "case kind " + " ".join(f"when '{k}' then {v}" for k, v in kinds.items()) + " end"


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``norm`` and ``surrogate`` for distinct entities (kind, norm), all surrogates distinct per kind.

    Of the entities with one candidate the smallest keeps it, unless it is an entity itself; the
    others draw again.
    """
    keys = F.broadcast(_key_table(entities.sparkSession, key))  # a row per kind

    def drawn(rows: DataFrame) -> DataFrame:
        streamed = rows.join(keys, "kind").withColumn("stream", F.expr(_stream())).withColumn("surrogate", F.expr(_candidate()))
        return streamed.select("kind", "norm", "attempt", "surrogate")

    table = kept_table(drawn(entities.select("kind", "norm").distinct().withColumn("attempt", F.lit(0))), "surrogates")
    while True:
        shared = table.groupBy("kind", "surrogate").agg(F.min("norm").alias("keeper"), F.count("*").alias("many")).where("many > 1").drop("many")
        real = table.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("taken"))
        checked = table.join(shared, ["kind", "surrogate"], "left").join(real, ["kind", "surrogate"], "left")
        again = F.coalesce("taken", F.lit(False)) | (F.col("keeper").isNotNull() & (F.col("keeper") != F.col("norm")))
        checked = kept_table(checked.select("kind", "norm", "attempt", "surrogate", again.alias("again")), "surrogates")
        if not checked.where("again").limit(1).count():
            return checked.select("kind", "norm", "surrogate")
        redrawn = drawn(checked.where("again").select("kind", "norm", (F.col("attempt") + 1).alias("attempt")))
        table = kept_table(checked.where("not again").select("kind", "norm", "attempt", "surrogate").unionByName(redrawn), "surrogates")


def _rendered() -> str:
    """A surrogate in the form of the mention: its digits in place, its letters in the mention's case.

    Digits of a surrogate that has more of them than the mention follow at its end.
    """
    count = "regexp_count(raw, '[0-9]')"
    # digits before the normalised ones (a country code) stay
    digits = f"concat(left(regexp_replace(raw, '[^0-9]', ''), {count} - length(norm)), surrogate)"
    filled = (
        f"aggregate(sequence(1, length(raw)), named_struct('out', '', 'k', 1, 'd', {digits}), (acc, i) -> if(substring(raw, i, 1) rlike '[0-9]',"
        " named_struct('out', concat(acc.out, substring(acc.d, acc.k, 1)), 'k', acc.k + 1, 'd', acc.d),"
        " named_struct('out', concat(acc.out, substring(raw, i, 1)), 'k', acc.k, 'd', acc.d)), acc -> concat(acc.out, substring(acc.d, acc.k)))"
    )
    name = "if(raw = upper(raw) and length(raw) > 1, upper(surrogate), initcap(surrogate))"
    mail = "if(raw = upper(raw), upper(surrogate), surrogate)"
    return f"case when kind in ('phone', 'card', 'ssn') then {filled} when kind in ('given_m', 'given_f', 'surname') then {name} when kind = 'mail' then {mail} else surrogate end"


def _called_again(base: DataFrame, spots: DataFrame, named: DataFrame, text: str) -> DataFrame:
    """``doc``, ``mark``, ``told`` and ``n_again`` for texts that hold a name after a title.

    ``told`` has, for each piece between entities, its capitalised words in order, with those that
    are names of the same text already replaced; ``n_again`` counts these.
    """
    people = spots.where(F.col("kind").isin("given_m", "given_f", "surname")).groupBy("doc", "mark", "norm").agg(F.min("kind").alias("kind"))
    people = people.join(named, ["kind", "norm"]).select(*[F.col(c).alias(f"of_{c}") for c in ("doc", "mark", "norm")], "kind", "surrogate")
    body = F.col(f"row.{text}")
    texts = base.where(body.rlike(WORDS["person"])).select("doc", "mark", F.split(body, PATTERN, -1).alias("pieces")).dropDuplicates(["doc", "mark"])
    words = texts.select("doc", "mark", F.posexplode("pieces").alias("piece", "body"))
    words = words.select("doc", "mark", "piece", F.posexplode_outer(F.regexp_extract_all("body", F.lit(CAPITAL), F.lit(0))).alias("word", "raw")).withColumn("norm", F.lower("raw"))
    same = F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("mark") == F.col("of_mark")) & (F.col("norm") == F.col("of_norm"))
    words = words.join(people, same, "left").withColumn("value", F.when(F.col("surrogate").isNull(), F.col("raw")).otherwise(F.expr(_rendered())))
    told = words.groupBy("doc", "mark", "piece").agg(
        F.array_sort(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "value")))).alias("values"), F.count("surrogate").alias("again")
    )
    told = told.groupBy("doc", "mark").agg(F.array_sort(F.collect_list(F.struct("piece", "values"))).alias("told"), F.sum("again").alias("n_again"))
    return told.select(F.col("doc").alias("in_doc"), F.col("mark").alias("in_mark"), F.expr("transform(told, t -> transform(t.values, v -> v.value))").alias("told"), "n_again")


def replace_entities(docs: DataFrame, key: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (the input row), ``safe`` (the text with surrogates) and ``n_entities`` per input row.

    ``key`` is the secret of the replacement: the same key gives the same surrogates for a table.
    """
    base = packed(docs).withColumn("doc", F.col(f"row.{doc}").cast("string")).withColumn("mark", F.xxhash64(F.col(f"row.{text}")))
    found = base.select("doc", "mark", F.regexp_extract_all(F.col(f"row.{text}"), F.lit(PATTERN), F.lit(0)).alias("mentions"))
    found = found.where("size(mentions) > 0").dropDuplicates(["doc", "mark"])
    parts = f"flatten(transform(mentions, m -> transform(array(''), piece -> {_parts()})[0]))"
    spots = found.select("doc", "mark", F.posexplode(F.expr(parts)).alias("pos", "part"))
    spots = spots.select("doc", "mark", "pos", F.col("part.kind").alias("kind"), F.col("part.raw").alias("raw")).withColumn("norm", F.expr(_normal()))
    spots = kept_table(spots, "entities")
    named = surrogates(spots, key)
    values = spots.join(named, ["kind", "norm"]).withColumn("value", F.expr(_rendered()))
    values = values.groupBy("doc", "mark").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("spots"))
    again = _called_again(base, spots, named, text)
    values = values.join(again, (F.col("mark") == F.col("in_mark")) & F.col("doc").eqNullSafe(F.col("in_doc")), "left")
    values = values.select(F.col("doc").alias("of_doc"), F.col("mark").alias("of_mark"), F.expr("transform(spots, s -> s.value)").alias("given"), "told", "n_again")
    joined = base.join(values, (F.col("mark") == F.col("of_mark")) & F.col("doc").eqNullSafe(F.col("of_doc")), "left")
    joined = joined.withColumn("cut", F.when(F.col("given").isNotNull(), text_parts(F.col(f"row.{text}"))))
    retold = f"zip_with(cut.pieces, told, (body, words) -> array_join(zip_with(split(body, {_sql(CAPITAL)}, -1), words, (b, w) -> concat(b, coalesce(w, ''))), ''))"
    joined = joined.withColumn("cut", F.when(F.col("told").isNull(), F.col("cut")).otherwise(F.struct(F.expr(retold).alias("pieces"), F.col("cut.mentions").alias("mentions"))))
    glued = f"flatten(zip_with(slice(cut.pieces, 1, size(cut.mentions)), cut.mentions, (piece, m) -> {_parts()}))"
    joined = joined.withColumn("glue", F.expr(f"transform({glued}, p -> p.before)"))
    safe = F.expr("concat(array_join(zip_with(glue, given, (b, v) -> concat(b, v)), ''), element_at(cut.pieces, -1))")
    return joined.select("row", F.when(F.col("given").isNull(), F.col(f"row.{text}")).otherwise(safe).alias("safe"), (F.coalesce(F.size("given"), F.lit(0)) + F.coalesce("n_again", F.lit(0))).cast("long").alias("n_entities"))
