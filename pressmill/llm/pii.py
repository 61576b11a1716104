"""Surrogates for personal data, with DataFrame functions only.

Entities (e-mail and IP addresses, telephone, card, account and social security numbers, access keys, values of
keys named as such, names after a form of address or a phrase that introduces one) are found by one pattern; in a text that
introduces a name, so are all other mentions of its words. Digits without separators are a card number only if their
Luhn sum is right. What identifies an entity is its canonical form: digits alone for numbers,
lower case for addresses and keys, the single name for persons. Each canonical form gets a surrogate derived from a key
by SHA-256, so that all its mentions, in whatever format, get the same one: digits stay digits, letters stay letters of
their script, a valid card number stays valid, the domain of an address is replaced alike everywhere, a given name keeps
its gender, and separators, case and form of address are kept. Surrogates are checked over the whole corpus: of two
entities with one surrogate, and for a surrogate that is itself an entity of the corpus, a new one is derived until none
is left. From the third new one on addresses and keys take a wider shape (any octets, longer names and keys), as few
forms can fill their own. Where more than ``ROUNDS`` rounds are needed they go on while clashes get fewer, and end in an
error otherwise (digits of a fixed number, more of them in the corpus than there are free ones). Only texts that hold entities are shuffled.

Defined results: null text stays null; a text without entities stays as it is; rows with the same id and text get the
same text; other columns are kept; an empty table gives an empty table.

Not found: names that no form of address or phrase introduces anywhere in the text (capitals alone don't tell a name in
German or in headings), ten bare digits (they may be a time), street addresses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressmill.llm.common import free_name, shuffled, staged, table

KEY = "surrogates"
ROUNDS = 12

# Fixed patterns, one for each kind of entity, tried in this order at each place.
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
GAP = r"[!#$%&*|,;]{0,4}[ .-]?"  # between the groups of a telephone number
KEY_NAMES = r"(?i:password|passwd|pwd|secret|api[_-]?key|access[_-]?key|token)"
KEYED = rf"(?<![\p{{L}}\p{{N}}]){KEY_NAMES}(?:=[\"']?|\s{{0,2}}[=:]\s{{0,2}}[\"']?(?=[A-Za-z+/_-]*\d))[A-Za-z0-9+/_-]{{6,}}+"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"
SECRET = r"(?<![\p{L}\p{N}])(?:[0-9a-fA-F]{32,}+|(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9_-]{20,}+)(?![\p{L}\p{N}])"
IP = rf"(?<![\p{{N}}.])(?:{OCTET}\.){{3}}{OCTET}(?!\p{{N}}|\.\p{{N}})"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?:(?: ?\d{4}){3,6}(?: ?\d{1,4})?|(?: [A-Z]{4})(?: \d{4}){2,6}(?: \d{1,4})?|[A-Z0-9]{11,30})(?![\p{L}\p{N}])"
IPV6 = r"(?<![\p{L}\p{N}:.])(?=[0-9a-fA-F:]*\d)(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6})(?![\p{L}\p{N}:])"
SSN = r"(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])"
CARD = r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\p{L}\p{N}])"
NATIONAL = r"(?<![\p{N}+.,/-])(?:\(0\d{1,4}\) ?|0\d{2,4}[ /-])\d{3,4}[ -]?\d{3,4}(?![\p{N}-])|(?<![\p{N}+.,-])\d{3} \d{3} \d{4}(?![\p{N}-])"
PHONE = rf"{NATIONAL}|(?<![\p{{N}}+])(?:\+\d{{1,3}}{GAP})?(?:\(\d{{2,4}}\){GAP}|\d{{3}}[.-])\d{{3}}{GAP}\d{{4}}(?!\p{{N}})|(?<![\p{{N}}+])\+\d{{1,3}}(?:[ .-]?\d{{2,4}}){{3,4}}(?!\p{{N}})"
MALE, FEMALE = r"Mr|Herr|Monsieur|Señor|Sr|г-н", r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|г-жа"
NEUTRAL = r"Dr|Prof|Doktor|Doctor|Professor|[Mm]y name is|[Mm]e llamo|[Mm]i nombre es|[Jj]e m.appelle|[Ii]ch heiße|[Mm]ein Name ist"
TITLE = rf"(?:{FEMALE}|{MALE}|{NEUTRAL})\.? "
NAME = rf"(?<![\p{{L}}]){TITLE}\p{{Lu}}[\p{{Ll}}'-]+(?: \p{{Lu}}[\p{{Ll}}'-]+)?"
ENTITY = "|".join((KEYED, EMAIL, SECRET, IP, IPV6, IBAN, SSN, CARD, PHONE, NAME))
#: What every entity has; a cheap test that spares most texts the search.
MAYBE = rf"[0-9@]|{KEY_NAMES}=|{TITLE}\p{{Lu}}"
# Syllables of made-up names, by script.
LATIN = ("ba", "ce", "do", "fi", "ga", "he", "jo", "ki", "la", "me", "no", "pi", "ra", "se", "to", "vi", "wa", "xe", "yo", "zu")
CYRILLIC = ("ба", "ве", "го", "ди", "жа", "зе", "ко", "ли", "ма", "не", "по", "ри", "са", "те", "фо", "хи", "ца", "че", "шо", "ю")


#: Letters to choose from, of scripts other than Latin.
SCRIPTS = {"Cyrillic": "абвгдежзийклмнопрстуфхцчшщэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω", "Arabic": "ابتجحدرسصطعفقكلمنهوي", "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת", "Han": "山川木水火土金日月人口田中大小上下石竹雨", "Hiragana": "あいうえおかきくけこさしすせそ", "Katakana": "アイウエオカキクケコサシスセソ", "Hangul": "가나다라마바사아자차카타파하"}


def quoted(values: tuple[str, ...]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def luhn(digits: str) -> str:
    """The Luhn sum of a digit string, modulo 10."""
    return f"pmod(aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if(i % 2 = 1, cast(substring({digits}, -i, 1) as int), pmod(2 * cast(substring({digits}, -i, 1) as int), 10) + cast(floor(2 * cast(substring({digits}, -i, 1) as int) / 10) as int))), 10)"


def check_digits(text: str, country: str) -> str:
    """The two check digits of an account number: 98 less the remainder by 97 of number, country and 00, letters as 10 to 35."""
    whole = f"concat({text}, {country}, '00')"
    step = f"if(substring({whole}, i, 1) rlike '[0-9]', pmod(10 * s + ascii(substring({whole}, i, 1)) - 48, 97), pmod(100 * s + ascii(substring({whole}, i, 1)) - 55, 97))"
    return f"lpad(cast(98 - aggregate(sequence(1, length({whole})), 0, (s, i) -> {step}) as string), 2, '0')"


LUHN = luhn("e")
#: Entity e to its parts: (kind, canonical form); ``people`` are the parts of the names that its text introduces.
PARTS = rf"""
case
  when e rlike r'^{KEY_NAMES}\s{{0,2}}[=:]' then transform(array(regexp_extract(e, r'([A-Za-z0-9+/_-]+)\z', 1)),
    v -> named_struct('kind', 'secret', 'form', if(v rlike r'^[0-9a-fA-F]+\z', lower(v), v)))
  when contains(e, '@') then array(named_struct('kind', 'email', 'form', lower(e)))
  when e rlike r'^(?:{OCTET}\.){{3}}{OCTET}\z' then array(named_struct('kind', 'ip', 'form', e))
  when e rlike r'^[0-9a-fA-F:]+\z' and contains(e, ':') then array(named_struct('kind', 'ipv6', 'form', lower(e)))
  when e rlike r'^(?:[0-9a-fA-F]{{32,}}|AKIA|ASIA|gh[pousr]_|sk-)' then array(named_struct('kind', 'secret', 'form', if(e rlike r'^[0-9a-fA-F]+\z', lower(e), e)))
  when e rlike r'^[A-Z]{{2}}\d\d' then array(named_struct('kind', 'iban', 'form', regexp_replace(e, '[^0-9A-Z]', '')))
  when e rlike r'^\d{{3}}-\d\d-\d{{4}}\z' then array(named_struct('kind', 'ssn', 'form', regexp_replace(e, '[^0-9]', '')))
  when e rlike r'^{TITLE}' then transform(split(regexp_replace(e, r'^{TITLE}', ''), ' '), w -> named_struct('kind', get(filter(people, p -> p.form = lower(w)), 0).kind, 'form', lower(w)))
  when e rlike r'^\p{{L}}' then transform(array(e), w -> named_struct('kind', coalesce(get(filter(people, p -> p.form = lower(w)), 0).kind, 'plain'), 'form', lower(w)))
  when e rlike r'^\d{{13,}}\z' and {LUHN} <> 0 then array(named_struct('kind', 'plain', 'form', e))
  when e rlike r'^\d' and length(regexp_replace(e, '[^0-9]', '')) >= 13 then array(named_struct('kind', 'card', 'form', regexp_replace(e, '[^0-9]', '')))
  else array(named_struct('kind', 'phone', 'form', regexp_replace(e, '[^0-9]', '')))
end"""

DIGIT = "cast(pmod(xxhash64(seed, i), 10) as string)"


def letters(text: str, seed: str) -> str:
    """Each digit and letter of a text replaced by another of its class and script; the rest stays."""
    scripts = " ".join(rf"when substring({text}, i, 1) rlike r'\p{{Is{name}}}' then substring('{chosen}', cast(1 + pmod(xxhash64({seed}, i), {len(chosen)}) as int), 1)" for name, chosen in SCRIPTS.items())
    return rf"""array_join(transform(sequence(1, length({text})), i -> case
      when substring({text}, i, 1) rlike '[0-9]' then cast(pmod(xxhash64({seed}, i), 10) as string)
      when substring({text}, i, 1) rlike '[A-Z]' then char(65 + pmod(xxhash64({seed}, i), 26))
      {scripts}
      when substring({text}, i, 1) rlike r'\p{{L}}' then char(97 + pmod(xxhash64({seed}, i), 26))
      else substring({text}, i, 1) end), '')"""


def syllables(table_sql: str) -> str:
    return f"array_join(transform(sequence(1, 3 + attempt), i -> element_at({table_sql}, cast(1 + pmod(xxhash64(seed, i), 20) as int))), '')"


def numbered(keep: str) -> str:
    return f"array_join(transform(sequence(1, length(form)), i -> if(i <= {keep}, substring(form, i, 1), {DIGIT})), '')"


def longer(first: int, after: int = 2) -> str:
    """Letters from ``first`` on, one more with each attempt after a few."""
    return f"if(attempt > {after}, array_join(transform(sequence(1, attempt - {after}), i -> char({first} + pmod(xxhash64(seed, 'longer', i), {6 if after > 2 else 26}))), ''), '')"


#: The domain of an address without its last label.
DOMAIN = r"regexp_replace(split_part(form, '@', 2), r'[^.]*\z', '')"

#: Surrogate of (kind, form) at an attempt; ``seed`` is the keyed hash of all three, ``domain_seed`` of the domain alone.
SURROGATE = rf"""
case
  when kind = 'email' then concat({letters("split_part(form, '@', 1)", "seed")}, {longer(97)}, '@',
    {letters(DOMAIN, "domain_seed")}, regexp_extract(form, r'[^.]*\z', 0))
  when kind = 'ip' and attempt > 2 then array_join(transform(sequence(1, 4), i -> cast(1 + pmod(xxhash64(seed, i), 254) as string)), '.')
  when kind = 'ip' then array_join(transform(split(form, '[.]'), (o, i) -> cast(case length(o) when 1 then 1 + pmod(xxhash64(seed, i), 9) when 2 then 10 + pmod(xxhash64(seed, i), 90) else 100 + pmod(xxhash64(seed, i), 155) end as string)), '.')
  when kind = 'ipv6' then array_join(transform(sequence(1, length(form)), i -> if(substring(form, i, 1) = ':', ':', lower(hex(pmod(xxhash64(seed, i), 16))))), '')
  when kind = 'secret' and form rlike r'^[0-9a-f]+\z' then array_join(transform(sequence(1, length(form)), i -> lower(hex(pmod(xxhash64(seed, i), 16)))), '') || {longer(97, 6)}
  when kind = 'secret' and not form rlike '[A-Za-z0-9]' then array_join(transform(sequence(1, length(form)), i -> char(65 + pmod(xxhash64(seed, i), 26))), '') || {longer(65)}
  when kind = 'secret' then concat(regexp_extract(form, '^(?:AKIA|ASIA|gh[pousr]_|sk-)', 0), {letters("regexp_replace(form, '^(?:AKIA|ASIA|gh[pousr]_|sk-)', '')", "seed")}, {longer(65)})
  when kind = 'iban' then transform(array({letters("substring(form, 5)", "seed")}), b -> concat(substring(form, 1, 2), {check_digits("b", "substring(form, 1, 2)")}, b))[0]
  when kind = 'card' and luhn = 0 then concat(substring(plain, 1, length(plain) - 1), cast(pmod(10 - {luhn("concat(substring(plain, 1, length(plain) - 1), '0')")}, 10) as string))
  when kind in ('card', 'ssn', 'phone') then plain
  when kind = 'surname_latin' then {syllables(quoted(LATIN))}
  when kind = 'male_latin' then concat({syllables(quoted(LATIN))}, 'n')
  when kind = 'female_latin' then concat({syllables(quoted(LATIN))}, 'na')
  when kind = 'neutral_latin' then concat({syllables(quoted(LATIN))}, 'l')
  when kind = 'male_cyrillic' then concat({syllables(quoted(CYRILLIC))}, 'н')
  when kind = 'female_cyrillic' then concat({syllables(quoted(CYRILLIC))}, 'на')
  else {syllables(quoted(CYRILLIC))}
end"""

#: Entity e with the surrogates s of its parts written in the entity's own format.
WRITTEN = rf"""
case
  when e rlike r'^{KEY_NAMES}\s{{0,2}}[=:]' then concat(regexp_replace(e, r'[A-Za-z0-9+/_-]+\z', ''), if(e rlike r'[0-9A-F]+\z' and e = upper(e), upper(s[0]), s[0]))
  when e rlike r'^{TITLE}' then concat(regexp_extract(e, r'^{TITLE}', 0), array_join(transform(s, w -> concat(upper(substring(w, 1, 1)), substring(w, 2))), ' '))
  when e rlike r"^[\p{{L}}'-]+\z" and e = upper(e) then upper(s[0])
  when e rlike r"^\p{{Lu}}[\p{{Ll}}'-]+\z" then concat(upper(substring(s[0], 1, 1)), substring(s[0], 2))
  when contains(e, ':') and e rlike r'^[0-9a-fA-F:]+\z' then if(e = upper(e), upper(s[0]), s[0])
  when contains(e, '@') or contains(e, '.') and e rlike r'^[\d.]+\z' then if(e = upper(e) and e <> lower(e), upper(s[0]), s[0])
  when e rlike r'^[0-9a-fA-F]{{32,}}\z' then if(e = upper(e), upper(s[0]), s[0])
  when e rlike '^(?:AKIA|ASIA|gh[pousr]_|sk-)' then s[0]
  else array_join(transform(sequence(1, length(e)), i -> if(substring(e, i, 1) rlike '[0-9A-Z]', substring(s[0], length(regexp_replace(substring(e, 1, i), '[^0-9A-Z]', '')), 1), substring(e, i, 1))), '')
end"""


def surrogates(forms: DataFrame, key: str) -> DataFrame:
    """(kind, form, surrogate) for distinct (kind, form): no two alike within a kind, none that is a form of the corpus."""
    forms = forms.withColumn("attempt", F.lit(0))
    clashes, done = None, 0
    while True:
        seeded = forms.withColumn("seed", F.sha2(F.concat_ws("|", F.lit(key), "kind", "form", "attempt"), 256)).withColumn("domain_seed", F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.expr("split_part(form, '@', 2)")), 256))
        seeded = seeded.withColumn("plain", F.expr(f"case when kind = 'card' then {numbered('1')} when kind = 'phone' then {numbered('length(form) - 10')} when kind = 'ssn' then {numbered('0')} end")).withColumn("luhn", F.expr(f"case when kind = 'card' then {luhn('form')} end"))
        made = seeded.select("kind", "form", "attempt", F.expr(SURROGATE).alias("surrogate"))
        taken = forms.select(F.col("kind").alias("k"), F.col("form").alias("f"))
        first = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("attempt", "form"))
        checked = made.withColumn("place", first).join(shuffled(taken), (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("f")), "left")
        checked = staged(checked.select("kind", "form", "attempt", "surrogate", ((F.col("place") > 1) | F.col("f").isNotNull()).alias("clash")), "surrogates")
        before, clashes, done = clashes, checked.where("clash").count(), done + 1
        if not clashes:
            break
        if done >= ROUNDS and before is not None and clashes >= before:
            raise ValueError(f"{clashes} entities are left without a surrogate of their own after {done} rounds")
        forms = checked.select("kind", "form", F.when(F.col("clash"), F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt"))
    return checked.select("kind", "form", "surrogate")


def replace_private(docs: DataFrame, key: str = KEY, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_entities") -> DataFrame:
    """The same rows and columns with the text rewritten, and last the number of entities (where ``count_col`` is set; it
    replaces a column of that name)."""
    names = [c for c in docs.columns if c != count_col]
    text = F.col(text_col)
    found, row, new, words, people, pattern, count = (free_name(docs, n) for n in ("_entities", "_row", "_new", "_words", "_people", "_pattern", "_count"))
    ents = F.when(text.rlike(MAYBE), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = docs.select(*names, F.coalesce(ents, F.array().cast("array<string>")).alias(found))
    clean = rows.where(F.size(found) == 0).select(*names, *([F.lit(0).alias(count_col)] if count_col else []))
    held = rows.where(F.size(found) > 0).withColumn(row, F.sha2(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), text), 256))
    # in a text that introduces names, their words are entities wherever they stand
    named = F.array_distinct(F.flatten(F.transform(F.filter(found, lambda e: e.rlike(f"^{TITLE}")), lambda e: F.array_compact(F.filter(F.split(F.regexp_replace(e, f"^{TITLE}", ""), " "), lambda w: F.length(w) > 2)))))
    held = held.withColumn(words, named)
    anywhere = F.concat(F.lit(ENTITY + r"|(?<![\p{L}\p{N}@._-])(?:"), F.array_join(F.flatten(F.transform(words, lambda w: F.array(w, F.upper(w)))), "|"), F.lit(r")(?![\p{L}\p{N}@_])"))
    held = held.withColumn(people, F.when(F.size(words) > 0, F.flatten(F.transform(F.filter(found, lambda e: e.rlike(f"^{TITLE}")), parts_of_name))).otherwise(F.array().cast("array<struct<kind:string,form:string>>")))
    held = held.withColumn(pattern, F.when(F.size(words) > 0, anywhere).otherwise(F.lit(ENTITY)))
    held = staged(held.withColumn(found, F.when(F.size(words) > 0, F.regexp_extract_all(text, F.col(pattern), F.lit(0))).otherwise(F.col(found))).drop(words), "private")
    mentions = held.select(F.col(row).alias("_row"), F.col(people).alias("people"), F.posexplode(found).alias("_at", "e")).select("_row", "_at", "e", F.posexplode(F.expr(PARTS)).alias("_part", "p"))
    mentions = staged(mentions.select("_row", "_at", "e", "_part", F.col("p.kind").alias("kind"), F.col("p.form").alias("form")), "mentions")
    same = mentions.where("kind = 'plain'").select("kind", "form", F.col("form").alias("surrogate")).distinct()
    mapping = surrogates(mentions.where("kind <> 'plain'").select("kind", "form").distinct(), key).unionByName(same)
    written = mentions.join(shuffled(mapping), ["kind", "form"]).groupBy("_row", "_at", "e").agg(F.sort_array(F.collect_set(F.struct("_part", "surrogate"))).alias("found"), F.max(F.col("kind") != "plain").alias("private"))
    written = written.select("_row", "_at", "e", "private", F.expr("transform(found, x -> x.surrogate)").alias("s")).select("_row", "_at", "private", F.when(F.col("private"), F.expr(WRITTEN)).otherwise(F.col("e")).alias("new"))
    per_row = written.groupBy("_row").agg(F.expr("transform(sort_array(collect_list(struct(_at, new))), x -> x.new)").alias(new), F.count_if("private").cast("int").alias(count)).withColumnRenamed("_row", row)
    between = F.when(F.col(pattern) == ENTITY, F.split(text, ENTITY, -1)).otherwise(F.split(text, F.col(pattern), -1))
    rewritten = F.array_join(F.concat(F.transform(F.col(new), lambda one, i: F.concat(F.element_at(between, i + 1), one)), F.array(F.element_at(between, -1))), "")
    dirty = held.join(shuffled(per_row), row).select(*[rewritten.alias(c) if c == text_col else F.col(c) for c in names], *([F.col(count).alias(count_col)] if count_col else []))
    return clean.unionByName(dirty)


def parts_of_name(e):
    """The parts of an entity with a title, as in ``PARTS``."""
    words = F.split(F.regexp_replace(e, f"^{TITLE}", ""), " ")
    gender = F.when(e.rlike(f"^(?:{FEMALE})[. ]"), "female").when(e.rlike(f"^(?:{MALE})[. ]"), "male").otherwise("neutral")
    kind = lambda i: F.when((i > 0) | (F.size(words) == 1), "surname").otherwise(gender)
    return F.transform(words, lambda w, i: F.struct(F.concat(kind(i), F.when(w.rlike(r"\p{IsCyrillic}"), "_cyrillic").otherwise("_latin")).alias("kind"), F.lower(w).alias("form")))


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replace_private(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), F.col("n_entities").cast("long").alias("n_entities"))
