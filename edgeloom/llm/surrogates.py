"""Surrogates for personal data: keyed replacements of the same type and format.

E-mail and IP addresses, phone and card numbers, hexadecimal secrets, and names after a form of address
are found by one pattern, and so are further mentions of these names in the same text without it. Each different entity gets one surrogate in the whole corpus, so
mentions of the same thing stay mentions of the same thing. Names are replaced name by name: the family
name of "Mr John Miller" and "Mr Miller" becomes the same. A given name's surrogate has the ending of
its gender, as the form of address tells it, and all names keep their script. A secret is the same
in capitals and small letters; its surrogate has the case that each mention has. A card or phone number is the
same with other separators between its digits; its surrogate stands between those of each mention. Numbers of 16 digits whose check
digit is wrong are no card numbers and stay; the surrogates of card numbers have a right one.

Surrogates are drawn from a hash of a secret key, the type, the entity and the number of the try.
Collision checks make them distinct: a try that equals an entity of the corpus, or the surrogate of
another entity of its type, is drawn again until none is left.

All of it is SQL functions and joins. Only texts that hold an entity take part in a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from edgeloom.llm.common import column_of, free_name, table
from edgeloom.plans.rounds import Rounds, written

KEY = "change this key"  # for tests and the registered query; users give their own

# Forms of address.
MALE = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "г-н", "господин", "κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Signora", "г-жа", "госпожа", "κυρία"]
EITHER = ["Dr", "Prof"]

TITLE_CAPITALS = ["MR", "MRS", "MS", "DR", "PROF", "HERR", "FRAU"]
PARTICLES = "van von vom der den dem ter ten de del della dello degli di da das do dos du des la le el al bin ibn ben bint zu zum zur af av y".split()

# Letters to the end of the word, with apostrophes and hyphens inside, but not the 's of a genitive.
_WORD = r"(?:[dl]['’]|(?:al|el)-)?\p{Lu}[\p{L}\p{M}]*+(?:(?:-|['’](?![sS](?![\p{L}\p{M}])))[\p{L}][\p{L}\p{M}]*+)*+"
_INITIAL = r"\p{Lu}\."
NAME = rf"(?<![\p{{L}}\p{{M}}\d])(?:{_INITIAL}|{_WORD})|(?<=\.)(?:{_INITIAL}|{_WORD})"  # one of them in a person
_NAMES = rf"(?:(?:{'|'.join(PARTICLES)}) )*+(?:{_INITIAL}|{_WORD})"
_TITLE = "|".join(sorted(MALE + FEMALE + EITHER + TITLE_CAPITALS, key=len, reverse=True))
PERSON = rf"(?<![\p{{L}}\d])(?:{_TITLE})\.? {_NAMES}(?:(?:(?<=\.) ?| |(?<=\.)-){_NAMES})*+"
REPEAT = rf"(?<![\p{{L}}\p{{M}}\d]){_WORD}"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}"
_BYTE = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?<![\d.]){_BYTE}(?:\.{_BYTE}){{3}}(?!\d|\.\d)"
PHONE = r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]\d{3,4}[ .-]?\d{3,4}(?!\d)"
COUNTRY = r"^(\+\d{1,3})[ .(-]"  # of a phone number
CARD = r"(?<!\d)\d{4}(?:[ -]?\d{4}){3}(?!\d)"
CARD_DIGITS = 12  # at least
SECRET = r"(?<![0-9A-Fa-f])(?=\d*[A-Fa-f])(?=[A-Fa-f]*\d)[0-9A-Fa-f]{32,64}(?![0-9A-Fa-f])"
# Cheap looks at the first character keep most places of a text from trying every alternative.
ENTITY = rf"(?:{PHONE}|{SECRET}|(?=\d)(?:{IP}|{CARD})|{EMAIL}|(?=[\p{{Lu}}г]|κυρία|κύριος){PERSON})"

LOWER, UPPER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
#: Syllables and endings of made-up names per script.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ge la le li lo ma me mi mo na ne ni no ra re ri ro sa se so ta te to va ve vi za",
    "cyrillic": "ба бе бо да де до га ге ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се со та те то ва ве ви за",
    "greek": "βα βε βο δα δε δο γα γε λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σο τα τε το φα φε φι ζα",
}
ENDINGS = {
    "latin": {"m": "rd lf ns rt", "f": "ria lia nna sa", "family": "mer ner ton sen", "given": "ris len"},
    "cyrillic": {"m": "мир слав дан рт", "f": "рия лия нна са", "family": "нко дзе сян рух", "given": "рис лен"},
    "greek": {"m": "νος ρος λος τος", "f": "ρια λια ννα σα", "family": "ρης λης νης δης", "given": "ρις λεν"},
}


def _kind(piece: Column) -> Column:
    return (
        F.when(piece.contains("@"), "email").when(piece.startswith("+"), "phone")
        .when(piece.rlike(rf"^{IP}$"), "ip").when(piece.rlike(r"^\d[\d -]*$") & (F.length(piece) < 20), "card")
        .when(piece.rlike(r"^[0-9A-Fa-f]+$"), "secret").otherwise("person")
    )


def _once(value: Column, work) -> Column:
    """``work`` of a value that is computed once, however often ``work`` names it."""
    return F.transform(F.array(value), work)[0]


def _digits(piece: Column) -> Column:
    return F.regexp_replace(piece, "[^0-9]", "")


def _check_sum(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled, as that of a card number is; 0 modulo 10 if it's right."""
    n = F.length(digits)

    def added(total: Column, i: Column) -> Column:
        digit = F.substr(digits, i + 1, F.lit(1)).try_cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when((n - i) % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(0), added)


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _gender(title: Column) -> Column:
    return (
        F.when(title.isin(MALE + ["MR", "HERR"]), "m").when(title.isin(FEMALE + ["MRS", "MS", "FRAU"]), "f").otherwise("given")
    )


def _part(prefix: Column, kind: Column, value: Column, form: Column) -> Column:
    return F.struct(prefix.alias("prefix"), kind.alias("kind"), value.alias("value"), form.alias("form"))


def _entity_of(name: Column) -> Column:
    """A name as one entity, whatever its letter case; initials lose their full stop."""
    return F.initcap(F.rtrim(name, F.lit(".")))


def _name_parts(before: Column, piece: Column) -> Column:
    """The names after a form of address: the last is a family name if it's no initial, the others are given ones."""
    words = F.split(piece, " ", 2)
    title, rest = F.concat(words[0], F.lit(" ")), words[1]
    names, gaps = F.regexp_extract_all(rest, F.lit(NAME), F.lit(0)), F.split(rest, NAME)
    given = F.concat(F.lit("given."), _gender(F.rtrim(words[0], F.lit("."))), F.lit("."))

    def opened(name: Column, i: Column) -> Column:
        family = (i == F.size(names) - 1) & ((i == 0) | (F.length(_entity_of(name)) > 1))
        kind = F.concat(F.when(family, F.lit("family.")).otherwise(given), _script(name))
        prefix = F.concat(F.when(i == 0, F.concat(before, title)).otherwise(F.lit("")), F.get(gaps, i))
        return _part(prefix, kind, _entity_of(name), name)

    return F.transform(names, opened)


def with_repeats(parts: Column, tail: Column) -> Column:
    """``parts`` and ``tail`` of a text with the untitled repeats of its own names as further parts.

    A last part without a kind holds what follows the last entity.
    """
    person = F.filter(parts, lambda p: p["kind"].rlike(r"^(family|given)\.") & (F.length(p["value"]) > 1))
    own = F.array_distinct(F.transform(person, lambda p: F.struct(p["value"].alias("value"), p["kind"].alias("kind"))))
    known = F.array_distinct(F.transform(person, lambda p: p["value"]))
    nothing = F.lit(None).cast("string")

    def in_gap(gap: Column) -> Column:
        """Each word of the gap like a name, with what stands before it, and the rest of the gap."""
        words, between = F.regexp_extract_all(gap, F.lit(REPEAT), F.lit(0)), F.split(gap, REPEAT)

        def word(w: Column, i: Column) -> Column:
            kind = F.get(F.filter(own, lambda o: o["value"] == _entity_of(w)), F.lit(0))["kind"]
            same = F.array_contains(known, _entity_of(w))
            return _part(F.get(between, i), F.when(same, kind), F.when(same, _entity_of(w)), w)

        return F.concat(F.transform(words, word), F.array(_part(F.element_at(between, -1), nothing, nothing, F.lit(""))))

    def opened(p: Column) -> Column:
        # The plain end of the gap goes before the entity.
        return F.concat(in_gap(p["prefix"]), F.array(_part(F.lit(""), p["kind"], p["value"], p["form"])))

    every = F.concat(F.flatten(F.transform(parts, opened)), in_gap(tail))
    plain = F.transform(parts, lambda p: _part(p["prefix"], p["kind"], p["value"], p["form"]))
    return F.when(F.size(person) > 0, every).otherwise(F.concat(plain, F.array(_part(tail, nothing, nothing, F.lit("")))))


def parts_of(text: Column) -> Column:
    """The entities of a text in order, each with the plain text before it."""
    gaps = F.split(text, ENTITY)
    pieces = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    pairs = F.zip_with(pieces, gaps, lambda piece, gap: F.struct(piece.alias("piece"), gap.alias("gap")))

    def opened(pair: Column) -> Column:
        piece, gap = pair["piece"], F.coalesce(pair["gap"], F.lit(""))
        kind, digits = _kind(piece), _digits(piece)
        wrong = (kind == "card") & _once(digits, lambda d: _check_sum(d) % 10 != 0)
        country = F.regexp_extract(piece, COUNTRY, 1)
        number = F.concat_ws(" ", F.nullif(country, F.lit("")), _digits(F.substr(piece, F.length(country) + 1, F.length(piece))))
        value = (
            F.when(kind == "secret", F.lower(piece)).when(kind == "card", digits).when(kind == "phone", number).otherwise(piece)
        )
        plain = F.array(_part(gap, F.when(~wrong, kind), F.when(~wrong, value), piece))
        return F.when(kind == "person", _name_parts(gap, piece)).otherwise(plain)

    return F.flatten(F.transform(F.filter(pairs, lambda p: p["piece"].isNotNull()), opened))


def _stream(key: str, kind: Column, value: Column, turn: Column) -> Column:
    """256 hex digits that depend on the key, the entity and the try."""
    seed = F.concat_ws("\u0001", F.lit(key), kind, turn.cast("string"), value)
    return F.concat(*[F.sha2(F.concat(seed, F.lit(f"\u0001{i}")), 256) for i in range(4)])


def _number(stream: Column, place: Column) -> Column:
    """A number below 65536 for a place; places further on than the stream wrap around."""
    return F.conv(F.substr(stream, place % 64 * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substr(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))


def _same_format(value: Column, stream: Column, hexadecimal: bool = False) -> Column:
    """Letters become letters, digits digits; all else stays."""

    def swapped(c: Column, i: Column) -> Column:
        n = _number(stream, i)
        if hexadecimal:
            return _pick(HEX, n)
        return (
            F.when(c.between("0", "9"), _pick(DIGITS, n)).when(c.between("a", "z"), _pick(LOWER, n))
            .when(c.between("A", "Z"), _pick(UPPER, n)).otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), swapped), "")


def _card(value: Column, stream: Column) -> Column:
    """As many digits, the last of which checks the others if they are as many as a card number has."""
    def checked(made: Column) -> Column:
        body = F.substr(made, F.lit(1), F.length(made) - 1)
        check = _once(F.concat(body, F.lit("0")), lambda d: (10 - _check_sum(d) % 10) % 10)
        return F.when(F.length(value) >= CARD_DIGITS, F.concat(body, check.cast("string"))).otherwise(made)

    return _once(_same_format(value, stream), checked)


def _name(kind: Column, stream: Column, turn: Column) -> Column:
    """A made-up name of the kind's script and ending; later tries are longer."""
    made = None
    for script, syllables in SYLLABLES.items():
        listed = F.array(*[F.lit(s) for s in syllables.split()])
        count = F.least(F.lit(12), F.lit(3) + F.floor(turn / 4).cast("int"))
        body = F.array_join(F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda i: F.element_at(listed, (_number(stream, i) % len(syllables.split()) + 1).cast("int")),
        ), "")
        for role, endings in ENDINGS[script].items():
            listed_ends = F.array(*[F.lit(e) for e in endings.split()])
            end = F.element_at(listed_ends, (_number(stream, F.lit(60)) % len(endings.split()) + 1).cast("int"))
            label = f"family.{script}" if role == "family" else f"given.{role}.{script}"
            made = (F if made is None else made).when(kind == label, F.concat(body, end))
    return F.initcap(made)


def surrogate(key: str, kind: Column, value: Column, turn: Column) -> Column:
    """One try at a surrogate for an entity."""
    stream = _stream(key, kind, value, turn)
    local, domain = F.split_part(value, F.lit("@"), F.lit(1)), F.split_part(value, F.lit("@"), F.lit(2))
    # Top-level domains and names reserved for examples stay as they are.
    top = F.regexp_extract(domain, r"((?:\.example)?\.[A-Za-z]+)$", 1)
    host = F.substr(domain, F.lit(1), F.length(domain) - F.length(top))
    address = F.concat(
        _same_format(local, stream), F.lit("@"),
        _same_format(host, _stream(key, F.lit("host"), host, turn)), top,
    )
    octets = F.array_join(F.transform(F.split(value, r"\."), lambda _, i: (_number(stream, i) % 256).cast("string")), ".")
    country = F.regexp_extract(value, COUNTRY, 1)
    phone = F.concat(country, _same_format(F.substr(value, F.length(country) + 1, F.length(value)), stream))
    return (
        F.when(kind == "email", address).when(kind == "ip", octets).when(kind == "phone", phone)
        .when(kind == "secret", _same_format(value, stream, hexadecimal=True))
        .when(kind == "card", _card(value, stream)).otherwise(_name(kind, stream, turn))
    )


def _said(kind: Column, form: Column, made: Column) -> Column:
    """A surrogate as a mention of the entity in this form would have it."""
    def cased(c: Column, i: Column) -> Column:
        return F.when(F.substr(form, i + 1, F.lit(1)).between("A", "F"), F.upper(c)).otherwise(c)

    secret = F.when(form == F.upper(form), F.upper(made)).otherwise(F.array_join(F.transform(F.split(made, ""), cased), ""))
    # Initials stay initials, capitals capitals.
    letter = F.length(F.rtrim(form, F.lit("."))) == 1
    short = F.concat(F.substr(made, F.lit(1), F.lit(1)), F.substr(form, F.lit(2), F.length(form)))
    name = F.when(letter, short).when(form == F.upper(form), F.upper(made)).otherwise(made)
    def laid(digits: Column) -> Column:
        def put(c: Column, i: Column) -> Column:
            place = F.length(_digits(F.substr(form, F.lit(1), i + 1)))
            return F.when(c.between("0", "9"), F.substr(digits, place, F.lit(1))).otherwise(c)

        return F.array_join(F.transform(F.split(form, ""), put), "")

    number = _once(_digits(made), laid)
    return (
        F.when(kind == "secret", secret).when(kind.isin("card", "phone"), number)
        .when(kind.rlike(r"^(family|given)\."), name).otherwise(made)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate`` for the distinct ``entities(kind, value)``.

    Surrogates of a kind are distinct, and none is a value of that kind.
    """
    with Rounds(entities.sparkSession) as rounds:
        entities, left = rounds.written(entities, rows=F.count("*"))
        pending, done, turn = entities, [], 0
        while left["rows"]:
            tries = pending.select("kind", "value", surrogate(key, F.col("kind"), F.col("value"), F.lit(turn)).alias("surrogate"))
            taken = entities.select("kind", F.col("value").alias("surrogate"))
            if done:
                taken = taken.union(reduce(DataFrame.union, done).select("kind", "surrogate"))
            free = tries.join(taken, ["kind", "surrogate"], "left_anti")
            # Of several tries with one outcome, the smallest value has it.
            first = free.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
            got, _ = rounds.written(first.select("kind", "value", "surrogate"))
            done.append(got)
            pending, left = rounds.written(pending.join(got, ["kind", "value"], "left_anti"), rows=F.count("*"))
            turn += 1
        if not done:
            return written(entities.withColumn("surrogate", F.lit("")))[0]
        return written(reduce(DataFrame.union, done))[0]


def replace_entities(docs: DataFrame, key: str, text: str = "text", count: str = "n_entities") -> DataFrame:
    """``docs`` with ``text`` rewritten and the number of entities, as a column ``count``.

    Null texts stay null and empty ones empty, with no entities. Repeated rows are rewritten alike.
    A column called like ``count`` is replaced; all others stay.
    """
    content = column_of(docs, text).cast("string")
    row, parts, tail, new = (free_name(docs, n) for n in ("_row", "_parts", "_tail", "_new"))
    gaps = F.split(content, ENTITY)
    found = docs.withColumn(parts, F.when(content.rlike(ENTITY), parts_of(content)))
    some = F.exists(column_of(found, parts), lambda p: p["kind"].isNotNull())
    found = found.withColumn(parts, F.when(some, column_of(found, parts)))
    found = found.withColumn(tail, F.when(column_of(found, parts).isNotNull(), F.element_at(gaps, -1)))
    found = found.withColumn(parts, with_repeats(column_of(found, parts), column_of(found, tail))).drop(tail)
    found = found.withColumn(row, F.monotonically_increasing_id())
    # The text of a row with entities is in its parts already.
    found = found.withColumn(text, F.when(column_of(found, parts).isNull(), content))
    marked, _ = written(found)
    plain = marked.where(column_of(marked, parts).isNull()).withColumn(count, F.lit(0))
    held = marked.where(column_of(marked, parts).isNotNull())
    each = held.select(F.col(row).alias("row"), F.posexplode(parts).alias("pos", "part")).select("row", "pos", "part.*")
    entities = each.where("kind is not null")
    mapping = assign(entities.select("kind", "value").distinct(), key)
    said = F.concat("prefix", _said(F.col("kind"), F.col("form"), F.col("surrogate")))
    swapped = entities.join(mapping, ["kind", "value"]).select("row", "pos", said.alias("said"), F.lit(1).alias("n"))
    stays = each.where("kind is null").select("row", "pos", F.concat("prefix", "form").alias("said"), F.lit(0).alias("n"))
    whole = swapped.union(stays).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("pos", "said"))).alias("all"), F.sum("n").cast("int").alias("n")
    )
    rewritten = whole.select(F.col("row").alias(row), F.array_join("all.said", "").alias(new), F.col("n").alias(count))
    joined = held.drop(count).join(rewritten, row)
    joined = joined.withColumn(text, column_of(joined, new))
    columns = [c for c in docs.columns if c.lower() != count.lower()] + [count]
    picked = [joined.select(*[column_of(joined, c) for c in columns]), plain.select(*[column_of(plain, c) for c in columns])]
    return picked[0].union(picked[1])


def op2_surrogates(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return replace_entities(docs, KEY)
