"""PII surrogates: detected entities get keyed replacements of their own type, in DataFrame functions only.

Entities are found with regular expressions and checksums, overlaps going to the earlier and then to the more specific one. Mentions of
one entity share a normal form (the digits of a number, the lower-case address, one name), and that form, not the mention, gets the
surrogate, so coreference survives in and across documents; a mention's own format is filled in again. What stays: the type, lengths,
separators, letter case, country and network digits, checksums of cards and IBANs, and a name's gender and script. Names are found after
a title, of any number of parts: the last is the surname, the others are given names. Phones are found in international form, and in national
form where their digits are grouped (area code in brackets, 3-3-4, 2 4 4); the two forms of a number are one entity.

The surrogate is drawn from a keyed SHA-256 of type, normal form and attempt. Collision checks over all entities of the corpus give
each surrogate to one entity and none to an entity that occurs itself; who loses tries again with the next attempt until none is left.
Names grow by a syllable with each attempt, and all other kinds by a character with each attempt after the first KEPT, so that there is
room even where every entity of a shape occurs; only then does a surrogate's length differ.

Plan: one pass writes the rows that hold entities, few of most corpora; their table settles surrogates, and only these rows are dealt
out. All others pass through a projection.

Defined cases: null text stays null and has no entity; empty text and text without entities come back unchanged; null ids are kept;
repeated rows give a row each, with equal results; an empty table gives an empty result; other columns are returned as they are,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions import text as T
from sieveline.llm.secret_scan import Rule
from sieveline.llm.shared import join_by_key, with_puts, written
from sieveline.operators.extract import fresh

#: Titles by the gender they tell.
MALE = ("Mr", "Herr", "Señor", "Sr", "Господин", "Г-н", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Mme", "Mlle", "Frau", "Señora", "Sra", "Госпожа", "Г-жа", "Κυρία")
EITHER = ("Dr", "Prof")
#: Syllables of made-up names by script, and endings by script and gender.
SYLLABLES = {"latin": "ba be bo da de do ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve vo".split(), "cyrillic": "ба бе бо да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то ва ве во".split(), "greek": "βα βε βο δα δε δο κα κε κο λα λε λο μα με μο να νε νο ρα ρε ρο σα σε σο τα τε το".split()}
ENDINGS = {"latin": {"given_f": "na", "given_m": "nus", "given_u": "ny", "surname": "sen"}, "cyrillic": {"given_f": "на", "given_m": "нис", "given_u": "ни", "surname": "сен"}, "greek": {"given_f": "να", "given_m": "νος", "given_u": "νι", "surname": "σεν"}}
_NAME = r"\p{Lu}[\p{L}'’-]+"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: The kinds of entity, the more specific first.
RULES = (
    Rule("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}"),
    Rule("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    Rule("phone", r"\+[0-9](?:[ .()-]{0,3}[0-9]){7,14}(?![0-9])|(?<![0-9+(.-])\([0-9]{2,4}\)[ -]?[0-9]{3,4}[ -][0-9]{4}(?![0-9-])|(?<![0-9.+-])[0-9]{3}[-. ][0-9]{3}[-.][0-9]{4}(?![0-9-]|\.[0-9])|(?<![0-9.+-])0[0-9] [0-9]{4} [0-9]{4}(?![0-9-])"),
    Rule("number", r"(?<![0-9])(?:[0-9]{4}[ -]?){3}[0-9]{4}(?![0-9])|(?<![0-9])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])|(?<![0-9])[0-9]{13,19}(?![0-9])"),
    Rule("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    Rule("ip", rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"),
    Rule("person", rf"(?<!\p{{L}})(?:{'|'.join(MALE + FEMALE + EITHER)})\.? {_NAME}(?: {_NAME})*"),
)
#: What a text must hold for a rule to look at it.
_MAY = {
    "email": lambda t: t.contains("@"), "phone": lambda t: t.contains("+") | t.rlike("[0-9]{3}[ .-][0-9]{3}"), "iban": lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), "number": lambda t: t.rlike("[0-9]{4}"),
    "ssn": lambda t: t.rlike("[0-9]{3}-[0-9]"), "ip": lambda t: t.rlike("[0-9][.][0-9]"), "person": lambda t: F.lit(True),
}
KINDS = ("email", "iban", "phone", "card", "account", "ssn", "ip", "given_f", "given_m", "given_u", "surname")
#: Attempts in which a surrogate keeps the length of what it stands for.
KEPT = 4
_MENTION = "struct<start: int, rank: int, kind: string, end: int, value: string>"
_MOD_97 = "aggregate(transform(split({x}, ''), c -> cast(conv(c, 36, 10) as bigint)), 0L, (a, c) -> if(c > 9, a * 100 + c, a * 10 + c) % 97)"


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _right_iban(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    letters = F.transform(F.split(F.concat(F.substring(plain, 5, 60), F.substring(plain, 1, 4)), ""), lambda c: F.conv(c, 36, 10).cast("long"))
    return F.aggregate(letters, F.lit(0).cast("long"), lambda a, c: F.when(c > 9, a * 100 + c).otherwise(a * 10 + c) % 97) == 1


def mentions(text: Column) -> Column:
    """start, end, kind, norm and value of the entities in a text, by start, without overlaps."""
    each = []
    for k, rule in enumerate(RULES):
        found = T.spans(text, rule.pattern)
        if rule.kind == "iban":  # only with a right checksum, so that others don't hide what they overlap
            found = F.filter(found, lambda s: _right_iban(s["value"]))
        listed = F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("rank"), F.lit(rule.kind).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))  # noqa: B023
        each.append(F.when(_MAY[rule.kind](text), listed).otherwise(F.expr(f"cast(array() as array<{_MENTION}>)")))
    apart = lambda at, s: (F.greatest(at, F.when(s["start"] >= at, s["end"]).otherwise(at)), F.when(s["start"] >= at, F.array(s)).otherwise(F.expr(f"cast(array() as array<{_MENTION}>)")))
    spans = T.folded(F.array_sort(F.concat(*each)), F.lit(0), _MENTION, apart)
    return F.flatten(F.transform(spans, _entities))


def _entities(s: Column) -> Column:
    """The entities of a span: one, or the parts of a name."""
    value = s["value"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    kind = F.when(s["kind"] != "number", s["kind"]).when(F.call_function("luhn_check", digits), "card").otherwise("account")
    norm = F.when(s["kind"] == "phone", _international(value, digits)).when(s["kind"] == "email", F.lower(value)).when(s["kind"] == "iban", F.replace(value, F.lit(" "), F.lit(""))).when(s["kind"] == "ip", value).otherwise(digits)
    one = F.struct(s["start"].alias("start"), s["end"].alias("end"), kind.alias("kind"), norm.alias("norm"), value.alias("value"))
    return F.when(s["kind"] == "person", _name_parts(s)).otherwise(F.array(one))


#: A national number of eight digits and an area code that zero begins.
_ZERO_FIRST = "^0[0-9] [0-9]{4} [0-9]{4}$"


def _international(value: Column, digits: Column) -> Column:
    """The digits of a phone with its country's: 61 where a zero begins groups of 2 4 4, 1 for ten digits; others, with a zero first or another length, have none."""
    ten = (F.length(digits) == 10) & ~digits.startswith("0")
    return F.when(value.startswith("+"), digits).when(value.rlike(_ZERO_FIRST), F.concat(F.lit("61"), F.substring(digits, 2, 9))).when(ten, F.concat(F.lit("1"), digits)).otherwise(digits)


def _name_parts(s: Column) -> Column:
    """A title with one name is a surname; of more, the last is the surname and the others are given names, of the title's gender (or of their ending)."""
    parts = F.split(s["value"], " ")
    title, names = F.replace(parts[0], F.lit("."), F.lit("")), F.slice(parts, 2, F.size(parts) - 1)
    gender = lambda name: F.when(title.isin(*MALE), "given_m").when(title.isin(*FEMALE), "given_f").when(name.rlike("[aаα]$"), "given_f").otherwise("given_u")

    def part(name: Column, k: Column) -> Column:
        last = k == F.size(parts) - 2
        end = s["end"] - F.length(F.array_join(F.slice(parts, k + 3, F.size(parts)), " ")) - F.when(last, 0).otherwise(1)
        kind = F.when(last, "surname").otherwise(gender(name))
        return F.struct((end - F.length(name)).alias("start"), end.alias("end"), kind.alias("kind"), F.lower(name).alias("norm"), name.alias("value"))

    return F.transform(names, part)


def _drawn(i: str) -> str:
    """A keyed number for place i of an entity's surrogate."""
    return f"cast(conv(substring(sha2(concat_ws('|', __key, kind, norm, attempt, {i}), 256), 1, 8), 16, 10) as bigint)"


def _more_drawn(i: str, made: str) -> str:
    """What a surrogate is lengthened with at place i; other draws than those of _drawn."""
    return made.format(x=_drawn(f"concat('+', {i})"))


def surrogate() -> str:
    """SQL for the surrogate of the columns kind, norm and attempt under the column __key."""
    more = f"greatest(0, attempt - {KEPT - 1})"
    place = "sequence(1, length(norm))"
    longer = f"sequence(1, length(norm) + {more})"
    char = "substring(norm, i, 1)"
    alike = f"CASE WHEN {char} rlike '[0-9]' THEN cast({_drawn('i')} % 10 as string) WHEN {char} rlike '[a-z]' THEN char(97 + {_drawn('i')} % 26) WHEN {char} rlike '[A-Z]' THEN char(65 + {_drawn('i')} % 26) ELSE {char} END"
    digit = f"cast({_drawn('i')} % 10 as string)"
    tail = f"array_join(transform(sequence(1, {more} + 1), i -> if(i > {more}, '', {_more_drawn('i', 'char(97 + {x} % 26)')})), '')"
    at = "instr(norm, '@')"
    tld = "length(norm) - locate('.', reverse(norm)) + 1"
    email = f"array_join(transform({place}, i -> concat(if(i = {at}, {tail}, ''), if(i = {at} or i > {tld}, {char}, {alike}))), '')"
    code = "if(substring(norm, 1, 1) in ('1', '7'), 1, 2)"
    phone = f"array_join(transform({longer}, i -> if(i <= {code}, {char}, if((i - {code}) % 3 = 1, cast(2 + {_drawn('i')} % 8 as string), {digit}))), '')"
    digits = f"array_join(transform({longer}, i -> if(i = 1, {char}, {digit})), '')"
    body = f"substring({digits}, 1, length(norm) + {more} - 1)"
    checked = f"element_at(filter(transform(sequence(0, 9), d -> concat({body}, d)), x -> luhn_check(x)), 1)"
    unchecked = f"element_at(filter(transform(sequence(0, 9), d -> concat({body}, (d + {_drawn('0')}) % 10)), x -> not luhn_check(x)), 1)"
    ssn = f"array_join(transform({longer}, i -> cast(1 + {_drawn('i')} % if(i = 1, 6, 9) as string)), '')"
    ip = f"array_join(transform(sequence(1, 4 + {more}), i -> cast(1 + {_drawn('i')} % 254 as string)), '.')"
    letters = f"concat(array_join(transform({place}, i -> if(i <= 4, '', {alike})), ''), upper({tail}))"
    iban = f"transform(array({letters}), b -> concat(substring(norm, 1, 2), lpad(cast(98 - {_MOD_97.format(x='concat(b, substring(norm, 1, 2), ' + chr(39) + '00' + chr(39) + ')')} as string), 2, '0'), b))[0]"
    names = []
    for script, test in (("cyrillic", r"[Ѐ-ӿ]"), ("greek", r"[Ͱ-Ͽ]"), ("latin", "")):
        syllables = "array(" + ", ".join(_quoted(s) for s in SYLLABLES[script]) + ")"
        ending = "CASE kind " + " ".join(f"WHEN '{k}' THEN {_quoted(v)}" for k, v in ENDINGS[script].items()) + " END"
        made = f"concat(array_join(transform(sequence(1, 3 + attempt), i -> {syllables}[cast({_drawn('i')} % {len(SYLLABLES[script])} as int)]), ''), {ending})"
        names.append(f"WHEN norm rlike {_quoted(test)} THEN {made}" if test else f"ELSE {made}")
    return f"CASE kind WHEN 'email' THEN {email} WHEN 'phone' THEN {phone} WHEN 'card' THEN {checked} WHEN 'account' THEN {unchecked} WHEN 'ssn' THEN {ssn} WHEN 'ip' THEN {ip} WHEN 'iban' THEN {iban} ELSE CASE {' '.join(names)} END END"


def settle(entities: DataFrame, key: str) -> DataFrame:
    """kind, norm, surrogate: distinct entities and their distinct surrogates, none of which is an entity of the kind itself.

    Room grows with every round, by a factor of ten at least, while entities don't, so that the rounds end."""
    made = F.expr(surrogate())
    names = F.when(F.col("kind").startswith("given"), "given").otherwise(F.col("kind"))
    state = written(entities.select("kind", "norm").distinct().withColumn("attempt", F.lit(0)))
    real = state.select(names.alias("real_space"), F.col("norm").alias("real")).distinct()
    while True:
        tried = written(state.withColumn("__key", F.lit(key)).withColumn("surrogate", made).withColumn("space", names).drop("__key"))
        owners = tried.groupBy("space", "surrogate").agg(F.min(F.struct("attempt", "kind", "norm")).alias("owner"))
        clash = tried.join(owners, ["space", "surrogate"]).join(real, (F.col("space") == F.col("real_space")) & (F.col("surrogate") == F.col("real")), "left")
        lost = (F.col("owner.kind") != F.col("kind")) | (F.col("owner.norm") != F.col("norm")) | F.col("real").isNotNull()
        clash = written(clash.select("kind", "norm", "attempt", "surrogate", lost.alias("lost")))
        if clash.where("lost").isEmpty():
            return clash.select("kind", "norm", "surrogate")
        state = clash.select("kind", "norm", (F.col("attempt") + F.col("lost").cast("int")).alias("attempt"))


def _as_mentioned(value: str) -> str:
    """SQL that gives a surrogate the format of the mention: its separators, or its letter case."""
    nth = f"length(regexp_replace(substring({value}, 1, i), '[^0-9]', ''))"
    # A national number lacks the country's digits, and may have a zero in their place.
    ahead = f"length(norm) - length(regexp_replace({value}, '[^0-9]', ''))"
    own = f"if(i = 1 AND kind = 'phone' AND {value} rlike '{_ZERO_FIRST}', '0', substring(surrogate, {nth} + {ahead}, 1))"
    filled = f"concat(array_join(transform(sequence(1, length({value})), i -> if(substring({value}, i, 1) rlike '[0-9]', {own}, substring({value}, i, 1))), ''), substring(surrogate, length(norm) + 1))"
    spaced = f"concat(array_join(transform(sequence(1, length({value})), i -> if(substring({value}, i, 1) = ' ', ' ', substring(surrogate, length(replace(substring({value}, 1, i), ' ', '')), 1))), ''), substring(surrogate, length(norm) + 1))"
    cased = f"if({value} = upper({value}), upper(surrogate), initcap(surrogate))"
    return f"CASE WHEN kind IN ('phone', 'card', 'account', 'ssn') THEN {filled} WHEN kind = 'iban' THEN {spaced} WHEN kind IN ('email', 'ip') THEN surrogate ELSE {cased} END"


def replace(docs: DataFrame, key: str) -> DataFrame:
    """docs with surrogates in text, and a last column: (start, end, kind, surrogate as written) of each entity of the old text, null
    without any. It is called __found, or another name that docs doesn't have."""
    (found,) = fresh(docs.columns, ["found"])
    row, in_text = fresh([*docs.columns, found], ["row", "mentions"])
    seen = docs.withColumn(in_text, mentions(F.coalesce(F.col("text"), F.lit(""))))
    touched = written(seen.where(F.size(in_text) > 0).withColumn(row, F.monotonically_increasing_id()))
    rows = touched.select(F.col(row).alias("row"), F.explode(in_text).alias("m")).select("row", "m.*")
    entities = written(rows.groupBy("kind", "norm").agg(F.count("*").alias("n")))
    settled = settle(entities, key).join(entities, ["kind", "norm"])
    put = join_by_key(rows, settled, ["kind", "norm"], "n").withColumn("put", F.expr(_as_mentioned("value")))
    each = put.groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "put"))).alias(found))
    changed = touched.join(each, row).withColumn("text", with_puts(F.col("text"), F.col(found)))
    kind = dict(changed.dtypes)[found]
    same = seen.where(F.size(in_text) == 0).withColumn(found, F.lit(None).cast(kind))
    names = [F.col(f"`{c}`") for c in (*docs.columns, found)]
    return same.select(*names).union(changed.select(*names))
