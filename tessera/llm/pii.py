"""Personal data replaced by keyed, type-consistent surrogates, with DataFrame operations only.

Detected: e-mail addresses, IBANs, card numbers, IPv4 addresses, social security numbers, telephone
numbers, names after a title, and in a document that has such a name every other mention of its parts. A mention is normalised to atoms (a name to one for
each part); an atom's surrogate depends on the key, the kind, the atom and an attempt number, so the same person or number gets the
same surrogate in every document and spelling, with any title or none. Surrogates keep format (length, separators, case, brand
digit, Luhn and mod-97 check digits, country, top-level domain), the script of names and letters, the gender of given names and the gendered
form of surnames. A given name's gender is its title's; without one that of its other mentions in the document, of its surname's form,
or of most mentions in the corpus.

Collision check, over the distinct atoms of the whole corpus: a surrogate must be unique in its kind
and be no original of its kind. Atoms that fail get the next attempt, until none fails; only those few
attempts travel back to the documents. The space grows with the attempt:
a name gets twice as many parts every ``STEP`` attempts, and from attempt ``KEEP_LENGTH`` on the local part of an e-mail address, a
telephone or a social security number gets more characters, for short ones have fewer surrogates than originals.
Addresses, cards and IBANs have at least 10^9 surrogates and keep their length.

The patterns run once over each text: the texts are written cut at their mentions, and all later steps read that table.

Edge cases: null texts stay null, empty ones empty; documents without a detection are returned
byte for byte; repeated and null ids keep their rows (rows are told apart by a number of their own); texts of any length are scanned
whole; an empty table gives an empty result; an input column n_entities gives way to the new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, small, table

KEY = "tessera"
STEP, KEEP_LENGTH = 4, 12
#: Attempts of colliding atoms are broadcast up to so many rows (each a few dozen bytes), else joined by shuffle.
BROADCAST_DOCS = 50_000

# Titles by gender, and given names and surnames by script.
MALE_TITLES = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Signora", "госпожа")
NEUTRAL_TITLES = ("Dr", "Prof")
NAMES = {
    "given_m_latin": "James Peter Lucas Martin Oscar Felix Hugo Anton Victor Simon Louis Mateo Diego Pablo Erik Jonas Karl Henry Arthur Leon",
    "given_f_latin": "Anna Maria Clara Emma Laura Julia Sofia Elena Lucia Marta Nora Alice Irene Helen Paula Carla Greta Ida Louise Jane",
    "given_n_latin": "Robin Kim Alex Sascha Noa Jamie Dominique Camille Charlie Andrea Sam Jules Maxime Toni Eden Rene",
    "family_latin": "Weber Keller Martin Bernard Moreau Garcia Lopez Romero Brown Clark Turner Walker Fischer Vogel Lambert Fontaine Vega Ortega Hughes Mills",
    "given_m_cyrillic": "Иван Пётр Олег Антон Павел Юрий Глеб Семён Игорь Максим",
    "given_f_cyrillic": "Анна Мария Ольга Елена Ирина Дарья Нина Вера Юлия Софья",
    "given_n_cyrillic": "Саша Женя Валя Слава",
    "family_cyrillic": "Орлов Лебедев Зайцев Волков Морозов Ильин Соколов Белов Крылов Фролов",
    "given_m_greek": "Γιώργος Νίκος Κώστας Δημήτρης Πέτρος Παύλος",
    "given_f_greek": "Μαρία Ελένη Άννα Σοφία Κατερίνα Δέσποινα",
    "given_n_greek": "Άρης Φίλη",
    "family_greek": "Παππάς Πετρίδης Σαμαράς Κανάρης Μανωλάς Ραφτόπουλος",
    "family_u_greek": "Νικολάου Γεωργίου Δήμου Ιωάννου Αθανασίου Βασιλείου",
}

_PART = r"\p{Lu}(?:\p{L}+|['’]\p{L}{2,})(?:['’-]\p{L}{2,})*+(?!\p{L})"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]{0,63}+@(?:[\p{L}\p{N}][\p{L}\p{N}-]{0,62}\.){1,8}\p{L}{2,24}(?![\p{L}\p{N}-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![0-9A-Za-z.+-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+.])(?:\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])",
    "person": r"(?<!\p{L})(?:" + "|".join(MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES) + rf")\.? {_PART}(?: {_PART}){{0,2}}",
}
COMBINED = "|".join(PATTERNS.values())

#: Characters that mark mentions in a text; one that the text does not hold is taken.
_MARKS = ("\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3")
_LATIN, _CYRILLIC, _GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω"


def _q(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _once(value: str, name: str, body: str) -> str:
    """body with name bound to value, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def kind_of(m: str) -> str:
    """The kind of a mention, by its form: the first pattern's that it has in full."""
    return (
        f"case when contains({m}, '@') then 'email' when {m} rlike '^[A-Z]{{2}}[0-9]{{2}}' then 'iban' "
        rf"when {m} rlike '^\\p{{L}}' then 'person' when {m} rlike '^([0-9]+[.]){{3}}[0-9]+$' then 'ip' when {m} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then 'ssn' "
        f"when {m} rlike '^[0-9]{{13,19}}$|^[0-9]{{4}}([ -][0-9]{{4}}){{3}}$' then 'card' else 'phone' end"
    )


def _script(p: str) -> str:
    return rf"case when {p} rlike '\\p{{IsCyrillic}}' then 'cyrillic' when {p} rlike '\\p{{IsGreek}}' then 'greek' else 'latin' end"


def _list(words) -> str:
    return ", ".join(_q(w) for w in words)


def _title(m: str) -> str:
    return f"regexp_replace(substring_index({m}, ' ', 1), '[.]$', '')"


def people_of(mentions: str) -> str:
    """array<struct<word, role, gender, norm, script>> of the names after titles: gender of a given name, or of a surname's form."""
    word = "lower(w)"
    form = rf"case when {word} rlike '(ов|ев|ёв|ин|ын)а$|ская$|[άαήη]$' then 'f' when {word} rlike '(ов|ев|ёв|ин|ын|ский|ς)$' then 'm' else 'n' end"
    stem = (
        rf"case when {word} rlike '\\p{{L}}(ов|ев|ёв|ин|ын)а$' then substring({word}, 1, length({word}) - 1) when {word} rlike 'ская$' then concat(substring({word}, 1, length({word}) - 4), 'ский') "
        rf"when {word} rlike '\\p{{IsGreek}}[άαήη]$' then concat({word}, 'ς') else {word} end"
    )
    titled = f"case when {_title('m')} in ({_list(MALE_TITLES)}) then 'm' when {_title('m')} in ({_list(FEMALE_TITLES)}) then 'f' else 'n' end"
    person = (
        f"transform(slice(split(m, ' '), 2, 3), (w, i) -> case when i = size(split(m, ' ')) - 2 then named_struct('word', w, 'role', 'family', 'gender', {form}, 'norm', {stem}, 'script', {_script('w')}) "
        f"else named_struct('word', w, 'role', 'given', 'gender', {titled}, 'norm', {word}, 'script', {_script('w')}) end)"
    )
    # a title without gender leaves it to the surname's form, where that is Cyrillic or Greek
    last = "element_at(p, -1)"
    told = f"transform(p, x -> case when x.role = 'given' and x.gender = 'n' and {last}.script in ('cyrillic', 'greek') then named_struct('word', x.word, 'role', x.role, 'gender', {last}.gender, 'norm', x.norm, 'script', x.script) else x end)"
    people = f"transform(filter({mentions}, m -> {kind_of('m')} = 'person' and {_title('m')} in ({_list(MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES)})), m -> {_once(person, 'p', told)})"
    return f"array_distinct(flatten({people}))"


def _known(word: str, role: str, gender: str, known: str) -> str:
    """The person part that a word stands for in its document: same role and gender first, then same role with a gender, then same role, then any."""
    same = f"lower(k.word) = lower({word})"
    tries = [f"{same} and k.role = {role} and k.gender = {gender} and {gender} <> 'n'", f"{same} and k.role = {role} and k.gender <> 'n'", f"{same} and k.role = {role}", same]
    return "coalesce(" + ", ".join(f"try_element_at(filter({known}, k -> {t}), 1)" for t in tries) + ")"


def _kind(part: str) -> str:
    """The kind of a person's part; Greek surnames that do not decline are one of their own."""
    family = f"case when {part}.script = 'greek' and {part}.gender = 'n' then 'family_u_greek' else concat('family_', {part}.script) end"
    return f"case when {part}.role = 'family' then {family} else concat('given_', {part}.gender, '_', {part}.script) end"


def atoms_of(m: str, known: str = "_known") -> str:
    """array<struct<kind, norm, form>> of a mention; known: the person parts of its document."""
    titled = f"{_title(m)} in ({_list(MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES)})"
    gender = f"case when {_title(m)} in ({_list(MALE_TITLES)}) then 'm' when {_title(m)} in ({_list(FEMALE_TITLES)}) then 'f' else 'n' end"
    words = f"case when {titled} then slice(split({m}, ' '), 2, 3) else split({m}, ' ') end"
    role = f"case when i = size({words}) - 1 then 'family' else 'given' end"
    person = f"transform({words}, (w, i) -> {_once(_known('w', role, gender, known), 'k', 'named_struct(' + _q('kind') + f', {_kind("k")}, ' + _q('norm') + ', k.norm, ' + _q('form') + ', k.gender)')})"
    plain = f"array(named_struct('kind', {kind_of(m)}, 'norm', case when {kind_of(m)} in ('phone', 'card', 'ssn') then regexp_replace({m}, '[^0-9]', '') when {kind_of(m)} = 'iban' then replace({m}, ' ', '') else lower({m}) end, 'form', 'n'))"
    return f"case when {kind_of(m)} = 'person' then {person} else {plain} end"


def _stream(key: str, kind: str, norm: str, attempt: str) -> str:
    seed = f"concat_ws('|', {_q(key)}, {kind}, {norm}, cast({attempt} as string))"
    return f"concat(sha2({seed}, 256), sha2(concat({seed}, '|2'), 256))"


def _word(h: str, i: str) -> str:
    return f"(cast(conv(substring({h}, 1 + 4 * ({i} % 32), 4), 16, 10) as int) + 7919 * {i})"


def _char(c: str, h: str, i: str) -> str:
    """A character of the same script and class; separators stay."""
    w = _word(h, i)
    pick = lambda alphabet: f"substring({_q(alphabet)}, 1 + {w} % {len(alphabet)}, 1)"
    return (
        f"case when {c} rlike '[0-9]' then cast({w} % 10 as string) when {c} rlike '[A-Z]' then upper({pick(_LATIN)}) when {c} rlike '[a-z]' then {pick(_LATIN)} "
        rf"when {c} rlike '\\p{{IsCyrillic}}' then {pick(_CYRILLIC)} when {c} rlike '\\p{{IsGreek}}' then {pick(_GREEK)} when {c} rlike '\\p{{L}}' then {pick(_LATIN)} else {c} end"
    )


def _chars(s: str, h: str) -> str:
    return f"array_join(transform(split({s}, ''), (c, i) -> {_char('c', h, 'i')}), '')"


def _luhn(d: str) -> str:
    """The Luhn sum of a digit string, modulo 10."""
    step = f"(a, i) -> a + {_once(f'cast(substring({d}, length({d}) - i, 1) as int) * (1 + i % 2)', 'v', 'cast(v div 10 + v % 10 as int)')}"
    return f"aggregate(sequence(0, length({d}) - 1), 0, {step}) % 10"


def _mod97(s: str) -> str:
    """The number that letters and digits stand for in an IBAN, modulo 97."""
    return f"aggregate(filter(split({s}, ''), c -> c <> ''), 0, (a, c) -> case when c rlike '[0-9]' then (a * 10 + ascii(c) - 48) % 97 else (a * 100 + ascii(c) - 55) % 97 end)"


def surrogate_of(key: str, kind: str, norm: str, attempt: str) -> str:
    """The surrogate of an atom, in normal form."""
    digits = f"transform(split({norm}, ''), (c, i) -> case when i = 0 then c when i = 1 then cast(2 + {_word('h', 'i')} % 8 as string) else cast({_word('h', 'i')} % 10 as string) end)"
    solid = f"array_join({digits}, '')"
    more = f"greatest(0, ({attempt}) - {KEEP_LENGTH - 1})"  # characters added: each attempt from KEEP_LENGTH on holds strings that none before held
    longer = lambda word: f"array_join(transform(slice(sequence(0, {more}), 2, {more}), i -> {word}), '')"
    at = "i + 20"
    plain = f"concat({solid}, {longer(f'cast({_word("h", f"({at})")} % 10 as string)')})"
    body = f"concat(substring({solid}, 1, length({norm}) - 1), '0')"
    card = f"case when {_luhn(norm)} = 0 then {_once(body, 'b', f'concat(substring(b, 1, length(b) - 1), cast((10 - {_luhn('b')}) % 10 as string))')} else {solid} end"
    ip = f"array_join(transform(split({norm}, '[.]'), (c, i) -> cast(case when i = 0 then 11 + {_word('h', 'i')} % 110 else 1 + {_word('h', 'i')} % 254 end as string)), '.')"
    domain = f"substring_index({norm}, '@', -1)"
    dstream = _stream(key, "'domain'", domain, "0")
    labels = f"substring({domain}, 1, length({domain}) - length(substring_index({domain}, '.', -1)) - 1)"
    tail = longer(f"substring({_q(_LATIN)}, 1 + {_word('h', f'({at})')} % {len(_LATIN)}, 1)")
    email = f"concat({_chars(f'substring_index({norm}, {_q("@")}, 1)', 'h')}, {tail}, '@', {_once(dstream, 'g', _chars(labels, 'g'))}, '.', substring_index({domain}, '.', -1))"
    country, account = f"substring({norm}, 1, 2)", _chars(f"substring({norm}, 5)", "h")
    sound = _once(account, "b", f"concat({country}, lpad(cast(98 - {_mod97(f'concat(b, {country}, {_q("00")})')} as string), 2, '0'), b)")
    iban = f"case when {_mod97(f'concat(substring({norm}, 5), substring({norm}, 1, 4))')} = 1 then {sound} else concat({country}, {_chars(f'substring({norm}, 3)', 'h')}) end"
    lists = "case " + " ".join(f"when {kind} = {_q(k)} then split({_q(v)}, ' ')" for k, v in NAMES.items()) + " end"
    name = _once(
        lists,
        "names",
        f"lower(array_join(transform(sequence(1, cast(power(2, ({attempt}) div {STEP}) as int)), i -> element_at(names, 1 + cast({_word('h', '(i - 1)')} % size(names) as int))), '-'))",
    )
    cases = f"case when {kind} in ('phone', 'ssn') then {plain} when {kind} = 'card' then {card} when {kind} = 'ip' then {ip} when {kind} = 'email' then {email} when {kind} = 'iban' then {iban} else {name} end"
    return _once(_stream(key, kind, norm, attempt), "h", cases)


def _inflected(name: str, form: str) -> str:
    """A surname in a gendered form; its parts one by one."""
    one = "case when x rlike '(ов|ев|ёв|ин|ын)$' then concat(x, 'а') when x rlike 'ский$' then concat(substring(x, 1, length(x) - 4), 'ская') when x rlike 'ς$' then substring(x, 1, length(x) - 1) else x end"
    return f"case when {form} = 'f' then array_join(transform(split({name}, '-'), x -> {one}), '-') else {name} end"


def render(key: str, m: str, attempts: str, known: str = "_known") -> str:
    """A mention's replacement: its atoms' surrogates in the mention's own format; attempts: map of kind|norm to (kind, attempt)."""
    told = f"try_element_at({attempts}, concat_ws({_q('|')}, x.kind, x.norm))"
    kind, attempt = f"coalesce({told}.kind, x.kind)", f"coalesce({told}.attempt, 0)"
    name = _once(surrogate_of(key, kind, "x.norm", attempt), "n", f"case when x.kind like 'family%' then {_inflected('n', 'x.form')} else n end")
    sub = f"transform({atoms_of(m, known)}, x -> {name})"
    nth = f"length(regexp_replace(substring({m}, 1, i + 1), '[^0-9]', ''))"
    digits = f"array_join(transform(split({m}, ''), (c, i) -> case when c rlike '[0-9]' then substring(s[0], {nth}, 1) else c end), '')"
    digits = f"concat({digits}, substring(s[0], 1 + length(regexp_replace({m}, '[^0-9]', ''))))"
    solid = f"length(replace(substring({m}, 1, i + 1), ' ', ''))"
    spaced = f"array_join(transform(split({m}, ''), (c, i) -> case when c = ' ' then c else substring(s[0], {solid}, 1) end), '')"
    cased = rf"array_join(transform(split({m}, ''), (c, i) -> case when c rlike '\\p{{Lu}}' then upper(substring(s[0], i + 1, 1)) else substring(s[0], i + 1, 1) end), '')"
    cased = f"concat({cased}, substring(s[0], 1 + length({m})))"
    titled = f"{_title(m)} in ({_list(MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES)})"
    part = f"split({m}, ' ')[i + case when {titled} then 1 else 0 end]"
    names = f"array_join(transform(s, (p, i) -> case when {part} = upper({part}) then upper(p) else replace(initcap(replace(p, '-', ' ')), ' ', '-') end), ' ')"
    person = f"case when {titled} then concat_ws(' ', substring_index({m}, ' ', 1), {names}) else {names} end"
    body = f"case when {kind_of(m)} in ('phone', 'card', 'ssn') then {digits} when {kind_of(m)} = 'iban' then {spaced} when {kind_of(m)} = 'email' then {cased} when {kind_of(m)} = 'person' then {person} else s[0] end"
    return _once(sub, "s", body)


def attempts_for(atoms: DataFrame, key: str = KEY) -> DataFrame | None:
    """(kind, norm, attempt) of the atoms whose first surrogate collides; None if none does.

    atoms: distinct (kind, norm) of the whole corpus, materialised. Among atoms with one surrogate the
    least keeps it, unless it is an original or was given away in an earlier round.
    """
    settled, pending, attempt = None, atoms, 0
    while True:
        cand = pending.withColumn("surrogate", F.expr(surrogate_of(key, "kind", "norm", str(attempt))))
        first = cand.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm"))
        first = first.join(atoms.select("kind", F.col("norm").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if settled is not None:
            first = first.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        kept = first.withColumn("attempt", F.lit(attempt))
        settled = materialise(kept if settled is None else settled.unionByName(kept))
        pending = materialise(pending.join(settled.select("kind", "norm"), ["kind", "norm"], "left_anti"))
        if pending.isEmpty():
            break
        attempt += 1
    return settled.where("attempt > 0").select("kind", "norm", "attempt") if attempt else None


def _cut(text: str, pattern: str) -> str:
    """The text cut at its mentions: plain, mention, plain, ..., in one scan; two where it holds every mark."""
    marks = " ".join(f"when not contains({text}, {_q(c)}) then split(regexp_replace({text}, {pattern}, {_q(c + '$0' + c)}), {_q(c)}, -1)" for c in _MARKS)
    slow = f"flatten(zip_with(split({text}, {pattern}, -1), regexp_extract_all({text}, {pattern}, 0), (a, b) -> case when b is null then array(a) else array(a, b) end))"
    return f"case {marks} else {slow} end"


def cut_texts(docs: DataFrame, text: str, row: str) -> DataFrame:
    """docs with a number of its own for each row, its text cut at the mentions, and the person parts of the document."""
    mentions = "filter(_cut0, (x, i) -> i % 2 = 1)"
    out = docs.withColumn("_cut0", F.expr(_cut(text, _q(COMBINED)))).withColumn("_known", F.expr(people_of(mentions)))
    # other mentions of a known person: its words as they stand, in capitals or capitalised, one or more in a row
    words = "array_distinct(flatten(transform(_known, k -> array(k.word, upper(k.word), initcap(k.word)))))"
    words = f"array_join({words}, '|')"
    more = f"concat({_q(COMBINED + r'|(?<!\p{L})(?:')}, {words}, {_q(')(?: (?:')}, {words}, {_q(r'))*(?!\p{L})')})"
    out = out.withColumn("_cut", F.expr(f"case when size(_known) > 0 then {_cut(text, more)} else _cut0 end")).drop("_cut0")
    return out.withColumn(row, F.monotonically_increasing_id())


def replace(docs: DataFrame, key: str = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col rewritten, and n_entities, the number of mentions replaced."""
    columns = [c for c in docs.columns if c != "n_entities"]
    plain = docs.select(F.struct(*columns).alias("_row"), F.col(text_col).cast("string").alias("_text"))
    # a row without a mention keeps its text only, one with mentions the cut one only
    cut = cut_texts(plain, "_text", "_id").withColumn("_cut", F.expr("case when size(_cut) > 1 then _cut end"))
    cut = materialise(cut.withColumn("_row", F.col("_row").withField(text_col, F.expr("case when _cut is null then _text end"))).drop("_text"))
    mentions = "filter(_cut, (x, i) -> i % 2 = 1)"
    found = cut.where("_cut is not null").select("_id", F.expr(f"array_distinct(flatten(transform({mentions}, m -> {atoms_of('m')})))").alias("x"))
    found = materialise(found.select("_id", F.explode("x").alias("x")).select("_id", "x.kind", "x.norm").distinct())
    # given names without a gender of their own take that of most documents
    gendered = found.where("kind rlike '^given_[mf]_'").select("norm", F.substring("kind", 9, 20).alias("script"), F.when(F.expr("kind like 'given_m%'"), 1).otherwise(-1).alias("g"))
    gendered = gendered.groupBy("norm", "script").agg(F.sum("g").alias("g")).select(F.concat(F.lit("given_n_"), "script").alias("kind"), "norm", F.expr("concat('given_', case when g > 0 then 'm' else 'f' end, '_', script)").alias("as_kind"))
    atoms = found.select("kind", "norm").distinct().join(gendered, ["kind", "norm"], "left").withColumn("as_kind", F.coalesce("as_kind", "kind"))
    atoms = materialise(atoms)
    extra = attempts_for(materialise(atoms.select(F.col("as_kind").alias("kind"), "norm").distinct()), key)
    none = F.expr("cast(map() as map<string,struct<kind:string,attempt:int>>)")
    if extra is not None:
        atoms = atoms.join(extra.withColumnRenamed("kind", "as_kind"), ["as_kind", "norm"], "left")
    else:
        atoms = atoms.withColumn("attempt", F.lit(0))
    told = materialise(atoms.withColumn("attempt", F.coalesce("attempt", F.lit(0))).where("attempt > 0 or kind <> as_kind"))
    if told.isEmpty():
        out = cut.withColumn("_try", none)
    else:
        told = F.broadcast(told) if small(told) else told
        entry = F.struct(F.concat_ws("|", "kind", "norm"), F.struct(F.col("as_kind").alias("kind"), "attempt"))
        by_row = materialise(found.join(told, ["kind", "norm"]).groupBy("_id").agg(F.map_from_entries(F.collect_set(entry)).alias("_try")))
        by_row = F.broadcast(by_row) if small(by_row, BROADCAST_DOCS) else by_row
        out = cut.join(by_row, "_id", "left").withColumn("_try", F.coalesce("_try", none))
    rewritten = f"array_join(transform(_cut, (m, i) -> case when i % 2 = 1 then {render(key, 'm', '_try')} else m end), '')"
    texts = F.expr(f"case when _cut is null then _row.`{text_col}` else {rewritten} end")
    count = F.expr("case when _cut is null then 0L else cast(size(_cut) div 2 as long) end").alias("n_entities")
    return out.select(*(texts.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in columns), count)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace(table(spark, sf_dir, "documents").select("doc_id", "text"))
