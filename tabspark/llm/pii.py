"""Surrogate generation for personal data, in DataFrame functions only.

A text is cut into segments: literal text and entities (e-mail addresses, phone numbers,
card numbers, national ids, bank accounts, IP addresses, and names after a form of address or
beginning with a known given name). An entity's surrogate is drawn from SHA-256 of a key, its
type, its canonical form and an attempt number, so one entity has one surrogate everywhere
(coreference), whatever its formatting, and each occurrence keeps its own format:
punctuation, case, length, check digits that were right or wrong, the gender and script of a
name. Attempts rise for all but one of the entities that would share a surrogate, or whose
surrogate is an entity of the corpus, until none is left.

A given name and its family name are one entity, a person, of the gender that any of its
forms of address, or the given name itself, tells. The family name has its surrogate from all
who bear it; the given name's is drawn for the person.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Forms of address by gender; those of Chinese follow the name.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος", "السيد"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία", "السيدة"],
    "u": ["Dr", "Prof", "الدكتور"],
}
AFTER = {"m": ["先生"], "f": ["女士", "小姐"], "u": ["博士", "教授"]}
#: Given names by gender and script.
GIVEN = {
    "m": "Adam Albert Anton Bruno Carl Daniel David Emil Felix George Hugo Ivan Jan Jonas Leo Lucas Martin Max Nico Noah Oscar Otto Paul Peter Robert Samuel Simon Theo Thomas Tim Victor Walter".split(),
    "f": "Ada Alice Amelia Anna Clara Diana Elena Ella Emma Eva Flora Greta Helena Ida Irene Julia Laura Lea Lina Lucia Maria Marta Mia Nina Nora Olivia Paula Rosa Sara Sofia Vera Zoe".split(),
    "mc": "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел Роман Семён Тимур Юрий".split(),
    "fc": "Алина Вера Дарья Елена Жанна Зоя Ирина Клара Лидия Мария Нина Ольга Полина Раиса София Юлия".split(),
    "mg": "Ανδρέας Γιώργος Δημήτρης Κώστας Μιχάλης Νίκος Πέτρος Σταύρος".split(),
    "fg": "Άννα Βασιλική Δέσποινα Ειρήνη Ελένη Κατερίνα Μαρία Σοφία".split(),
    "ma": "أحمد حسن خالد علي عمر كريم محمد يوسف".split(),
    "fa": "سارة سلمى عائشة فاطمة ليلى مريم نور هدى".split(),
    "mz": "伟 军 勇 强 明 杰 涛 磊".split(),
    "fz": "丽 娜 娟 敏 芳 艳 霞 静".split(),
}
#: Further given names by which a name without a form of address is known.
KNOWN = {
    "m": "Alexander Andrew Antonio Benjamin Charles Christian Claude Edward François Frank Hans Henry Jack Jacques James Javier Jean Johann John José Juan Karl Klaus Luis Manuel Michael Miguel Pablo Patrick Philip Pierre Richard Steven Wilhelm William".split(),
    "f": "Andrea Barbara Carmen Catherine Charlotte Christine Elizabeth Emily Helen Ingrid Isabel Jane Jennifer Jessica Karen Linda Louise Margaret Marie Mary Monika Patricia Sabine Sarah Susan Teresa Ursula".split(),
}
#: Family names of Chinese of one sign.
SURNAMES = "王李张刘陈杨黄赵周吴徐孙马朱胡林郭何高罗郑梁谢宋唐许邓韩冯曹彭曾肖田董潘袁蔡蒋余于杜叶程魏苏吕丁任卢姚沈钟姜崔谭陆范汪廖石金韦贾夏付方邹熊白孟秦邱侯江尹薛闫段雷龙黎史陶贺毛郝顾龚邵万覃武钱戴严莫孔向常"
#: Scripts with syllables of their own, by the letter that marks a kind, and these syllables.
SCRIPTS = {"c": "Cyrillic", "g": "Greek", "a": "Arabic", "h": "Hebrew", "z": "Han", "k": "Hangul", "d": "Devanagari", "e": "Armenian", "o": "Georgian"}
SYLLABLES = {
    "": "ba be bi bo da de di do ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se so ta".split(),
    "c": "ба бе би бо да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се со та".split(),
    "g": "βα βε δα δε δο κα κε κο λα λε λι λο μα με μι μο να νε νι νο πα πε πο ρα ρε ρι ρο σα σε σι τα το".split(),
    "a": "با بي دا دي را ري سا سي شا شي عا فا في قا كا كي لا لي ما مي نا ني ها هي وا وي يا تا تي جا حا زا".split(),
    "h": "בא גא דא הא וא זא חא טא יא כא לא מא נא סא עא פא צא קא רא שא תא בי די לי מי ני קי רי שי תי גי פי".split(),
    "z": list(SURNAMES[:64]),
    "k": "가 나 다 라 마 바 사 아 자 차 카 타 파 하 고 노 도 로 모 보 소 오 조 초 기 니 디 리 미 비 시 지".split(),
    "d": "क ख ग घ च छ ज झ ट ड त थ द ध न प फ ब भ म य र ल व श स ह का ना मा रा ला".split(),
    "e": "բա գա դա զա կա լա մա նա պա ռա սա վա տա րա քա ֆա բե գե դե կե լե մե նե սե տե րե բի գի դի կի լի մի".split(),
    "o": "ბა გა და ვა ზა თა კა ლა მა ნა პა რა სა ტა ფა ქა ბე გე დე ვე კე ლე მე ნე რე სე ბი გი დი კი ლი მი".split(),
}
#: Syllables of a family name, and of a given name where a script has no list of these.
LENGTH = {"z": 1, "k": 1}
FOUR, TWO = 4, 2
_ADDRESS = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_AFTER = "|".join(t for ts in AFTER.values() for t in ts)
_BY_NAME = "|".join(sorted({n for k in ("m", "f") for n in GIVEN[k] + KNOWN[k]} | {n for k in ("mc", "fc", "mg", "fg") for n in GIVEN[k]}, key=lambda n: (-len(n), n)))
_LOCAL = "[\\p{L}\\p{N}._%+-]"
_WORD = "(?:\\p{Lu}['’])?\\p{Lu}\\p{Ll}+(?:[-'’]\\p{Lu}\\p{Ll}+)*"
_BARE = "(?<![\\p{L}\\p{N}])"
_END = "(?![\\p{L}\\p{N}])"
_HEX = "[0-9A-Fa-f]{1,4}"
_NAME = f"{_BARE}(?=[\\p{{Lu}}\\p{{Lo}}])(?:(?:{_ADDRESS})\\.? (?:{_WORD}(?: {_WORD})?|\\p{{Lo}}+(?: \\p{{Lo}}+)?)|(?=\\p{{Lu}}\\p{{Ll}}+ \\p{{Lu}})(?:{_BY_NAME}) {_WORD}){_END}"
_HAN = f"(?=[一-鿿])[{SURNAMES}]\\p{{IsHan}}{{1,2}}(?:{_AFTER})"
#: What is an entity, by type; the first type that matches at a place wins.
PATTERNS = {
    "email": f"(?<!{_LOCAL}){_LOCAL}++@[\\p{{L}}\\p{{N}}-]++(?:\\.[\\p{{L}}\\p{{N}}-]++)+",
    "ipv6": f"(?<![\\p{{L}}\\p{{N}}:.])(?={_HEX}:)(?:(?:{_HEX}:){{7}}{_HEX}|(?:(?:{_HEX}:){{1,5}}{_HEX}|[fF][cdCDeE][0-9A-Fa-f]{{2}})::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\\p{{L}}\\p{{N}}:])",
    "ip": "(?<![\\p{L}\\p{N}.])(?:(?:25[0-5]|2[0-4]\\d|1\\d\\d|\\d?\\d)\\.){3}(?:25[0-5]|2[0-4]\\d|1\\d\\d|\\d?\\d)(?![\\p{L}\\p{N}]|\\.\\d)",
    "iban": f"{_BARE}[A-Z]{{2}}\\d{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?){_END}",
    "ssn": f"(?<![\\p{{L}}\\p{{N}}-])(?:\\d{{3}}-\\d{{2}}-\\d{{4}}|\\d{{9}})(?![\\p{{L}}\\p{{N}}]|-\\d)",
    "card": f"{_BARE}(?:\\d{{13,19}}|\\d{{4}}(?:[ -]\\d{{4}}){{3}}){_END}",
    "phone": f"(?<![\\p{{L}}\\p{{N}}+])(?:\\+\\d{{1,3}}[ .-]?)?(?:\\(\\d{{2,4}}\\) ?|\\d{{2,4}}[ .-])\\d{{3,4}}[ .-]\\d{{4}}(?![\\p{{L}}\\p{{N}}]|[.-]\\d)|(?<![\\p{{L}}\\p{{N}}+])\\+\\d{{8,15}}{_END}|(?<![\\p{{L}}\\p{{N}}+.-])\\d{{10,12}}(?![\\p{{L}}\\p{{N}}]|[.-]\\d)",
    "name": f"{_NAME}|{_HAN}",
}
#: All types at once: all but names of Chinese begin where no letter or digit stands before, which is looked at first.
ANY = f"{_BARE}(?:" + "|".join(f"(?:{p})" for k, p in PATTERNS.items() if k != "name") + f"|{_NAME})|{_HAN}"
#: What a text has at least where any of them matches.
SOME = f"[0-9@]|::|{_BARE}(?=[\\p{{Lu}}\\p{{Lo}}])(?:\\p{{Lu}}\\p{{Ll}}+ \\p{{Lu}}|(?:{_ADDRESS})\\.? )|{_HAN}"
#: Attempts between two looks whether a space of fixed length has room.
ATTEMPTS = 64
#: Attempts in the fixed pool or the own length; each later one adds a syllable or letter.
PLAIN = 4


def _kind(m: Column) -> Column:
    out = None
    for kind, p in PATTERNS.items():
        test = m.rlike(f"^(?:{p})$")
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _canonical(kind: Column, m: Column) -> Column:
    d = _digits(m)
    phone = F.when(F.length(d) > 10, F.substring(d, -10, 10)).otherwise(d)
    return F.when(kind.isin("email", "ipv6"), F.lower(m)).when(kind == "iban", F.upper(F.replace(m, F.lit(" "), F.lit("")))).when(kind == "ip", m).when(kind == "phone", phone).when(kind.isin("card", "ssn"), d).otherwise(F.lower(m))


def _segment(kind, text: Column, canon: Column | None = None) -> Column:
    kind = F.lit(kind).cast("string") if not isinstance(kind, Column) else kind
    return F.struct(kind.alias("kind"), text.alias("text"), F.when(kind.isNotNull(), _canonical(kind, text) if canon is None else canon).alias("canon"))


def _segments(text: Column) -> Column:
    """array<struct<kind,text,canon>>: the text in order; kind is null for what stays."""
    found, gaps = F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), F.split(text, ANY, -1)

    def person(title: Column, given: Column, family: Column, between: Column, after: Column, gender: Column, han: bool) -> Column:
        script = F.lit("")
        for mark, name in SCRIPTS.items():
            script = F.when(family.rlike(f"\\p{{Is{name}}}"), mark).otherwise(script)
        first = _segment(F.concat(F.lit("given_"), gender, script), given, F.lower(F.concat_ws(" ", given, family)))
        last = _segment(F.concat(F.lit("family"), script), family)
        named = F.array(last, first, _segment(None, after)) if han else F.array(_segment(None, title), first, _segment(None, between), last)
        return named if han else F.when(given != "", named).otherwise(F.array(_segment(None, title), last))

    def entity(m: Column) -> Column:
        title = F.regexp_extract(m, f"^((?:{_ADDRESS})\\.? )", 1)
        bare = F.regexp_replace(title, "[. ]", "")
        parts = F.split(F.substring(m, F.length(title) + 1, F.length(m)), " ")
        two = F.size(parts) == 2
        given, family = F.when(two, F.get(parts, F.lit(0))).otherwise(""), F.when(two, F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(0)))
        told = F.when(title != "", F.when(bare.isin(TITLES["m"]), "m").when(bare.isin(TITLES["f"]), "f").otherwise("u"))
        known = lambda g: given.isin([n for k in (GIVEN, KNOWN) for kind, ns in k.items() if kind[0] == g for n in ns])
        gender = F.coalesce(told, F.when(known("m"), "m").when(known("f"), "f").otherwise("u"))
        after = F.regexp_extract(m, f"({_AFTER})$", 1)
        whole = F.substring(m, F.lit(2), F.length(m) - F.length(after) - 1)
        han = person(F.lit(""), whole, F.substring(m, 1, 1), F.lit(""), after, F.when(after.isin(AFTER["m"]), "m").when(after.isin(AFTER["f"]), "f").otherwise("u"), True)
        named = F.when((after != "") & (title == ""), han).otherwise(person(title, given, family, F.lit(" "), F.lit(""), gender, False))
        return F.when(_kind(m) == "name", named).otherwise(F.array(_segment(_kind(m), m)))

    pairs = F.zip_with(gaps, found, lambda g, m: F.concat(F.array(_segment(None, g)), F.when(m.isNotNull(), entity(m)).otherwise(F.array(_segment(None, F.lit(""))))))
    return F.filter(F.flatten(pairs), lambda s: s["text"] != "")


def _pick(pool: Column, seed: Column, at: int | Column, n: int = 8) -> Column:
    return F.element_at(pool, F.pmod(F.conv(F.substring(seed, at, n), 16, 10).cast("long"), F.size(pool)).cast("int") + 1)


def _table(lists: dict[str, list[str]]) -> Column:
    """A literal map."""
    return F.create_map(*[x for k, xs in lists.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in xs]))])


def _syllables(pool: Column, seed: Column, many: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), many - 1), lambda i: _pick(pool, seed, 1 + 8 * i)), "")


def _longer(pool: Column, seed: Column, attempt: Column) -> Column:
    """Syllables after a name: none in the first PLAIN attempts, then one more in each, up to 32."""
    more = F.sha2(seed, 256)
    each = F.transform(F.sequence(F.lit(0), F.least(attempt - PLAIN, F.lit(31))), lambda i: _pick(pool, more, 2 * i + 1, 2))
    return F.when(attempt < PLAIN, "").otherwise(F.array_join(each, ""))


def _shaped(text: Column, stream: Column, letters: Column, keep_from_right: int | None = None) -> Column:
    """Digits and letters of ``text`` replaced from the streams, counted from the right; all else stays."""
    n = F.length(_digits(text))
    at = lambda s, i: F.substring(s, F.pmod(i, F.lit(64)).cast("int") + 1, 1)

    def one(c: Column, i: Column) -> Column:
        right = n - F.length(_digits(F.substring(text, 1, i + 1)))  # digits after this one
        letter = at(letters, i)
        out = F.when(c.rlike("[0-9]"), F.when(F.lit(keep_from_right is not None) & (right >= (keep_from_right or 0)), c).otherwise(at(stream, right)))
        return out.when(c.rlike("\\p{Lu}"), F.upper(letter)).when(c.rlike("\\p{L}"), letter).otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")


def _luhn(digits: Column) -> Column:
    """The check sum of the digits, the last one counted as it is."""
    d = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x) % 10


def _card(text: Column, canon: Column, stream: Column) -> Column:
    n = F.length(canon)
    body = F.concat(F.substring(canon, 1, 1), F.substring(stream, 1, n - 2))
    check = (10 - _luhn(F.concat(body, F.lit("0")))) % 10
    wrong = (check + 1 + F.substring(stream, 40, 1).cast("int") % 9) % 10
    whole = F.concat(body, F.when(_luhn(canon) == 0, check).otherwise(wrong).cast("string"))
    spread = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(whole, F.length(_digits(F.substring(text, 1, i + 1))), 1)).otherwise(c))
    return F.array_join(spread, "")


def _remainder(account: Column) -> Column:
    """The remainder by 97 of a bank account: its first four signs at the end, letters as 10 to 35."""
    signs = F.filter(F.split(F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4)), ""), lambda c: c != "")
    return F.aggregate(signs, F.lit(0), lambda r, c: F.when(c.rlike("[0-9]"), (r * 10 + F.ascii(c) - 48) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97))


def _iban(text: Column, canon: Column, stream: Column, letters: Column) -> Column:
    body = _shaped(F.substring(canon, F.lit(5), F.length(canon)), stream, letters)
    country = F.substring(canon, 1, 2)
    check = 98 - _remainder(F.concat(country, F.lit("00"), body))
    wrong = (check + 1 + F.ascii(F.substring(stream, 40, 1)) % 90) % 97
    whole = F.concat(country, F.lpad(F.when(_remainder(canon) == 1, check).otherwise(wrong).cast("string"), 2, "0"), body)
    spread = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c, i: F.when(c == " ", c).otherwise(F.substring(whole, i + 1 - F.length(F.regexp_replace(F.substring(text, F.lit(1), i), "[^ ]", "")), F.lit(1))))
    return F.array_join(spread, "")


def render(kind: Column, text: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an occurrence ``text`` of the entity (kind, canon)."""
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 256)
    stream = F.translate(seed, "abcdef", "274905")
    letters = F.translate(seed, "0123456789abcdef", "ghjklmnpqrstvwxz")
    domain = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), F.substring_index(canon, "@", -1)), 256)
    host = F.concat(F.lit("@"), F.translate(F.substring(domain, 1, 8), "0123456789abcdef", "ghjklmnpqrstvwxz"), F.lit(".example."), _pick(F.array(F.lit("com"), F.lit("net"), F.lit("org")), domain, 9))
    longer = F.when(attempt < PLAIN, "").otherwise(F.substring(F.translate(F.sha2(seed, 256), "0123456789abcdef", "ghjklmnpqrstvwxz"), F.lit(1), attempt - PLAIN + 1))
    email = F.concat(_shaped(F.substring_index(text, "@", 1), stream, letters), longer, host)
    octet = lambda i: (F.conv(F.substring(seed, 1 + 6 * i, 6), 16, 10).cast("long") % 254 + 1).cast("string")
    signs = F.filter(F.split(text, ""), lambda c: c != "")
    nibble = lambda i: F.substring(seed, F.pmod(i, F.lit(64)) + 1, F.lit(1))
    ipv6 = F.array_join(F.transform(signs, lambda c, i: F.when(c == ":", c).when(c.rlike("[A-F]"), F.upper(nibble(i))).otherwise(nibble(i))), "")
    out = F.when(kind == "email", F.when((text == F.upper(text)), F.upper(email)).otherwise(email)).when(kind == "ip", F.concat_ws(".", *[octet(i) for i in range(4)])).when(kind == "card", _card(text, canon, stream))
    out = out.when(kind == "phone", _shaped(text, stream, letters, 10)).when(kind == "ssn", _shaped(text, stream, letters)).when(kind == "ipv6", ipv6).when(kind == "iban", _iban(text, canon, stream, letters))
    script = F.regexp_replace(kind, "^(given_.|family)", "")
    pools = {k: v for k, v in GIVEN.items()} | {f"u{s}": GIVEN[f"m{s}"] + GIVEN[f"f{s}"] for s in ("", *SCRIPTS) if f"m{s}" in GIVEN}
    syllables = F.element_at(_table(SYLLABLES), script)
    drawn = F.try_element_at(_table(pools), F.substring(kind, 7, 2))
    given = F.when(drawn.isNull(), F.initcap(_syllables(syllables, seed, F.lit(TWO)))).otherwise(_pick(drawn, seed, 1))
    many = F.coalesce(*[F.when(script == s, n) for s, n in LENGTH.items()], F.lit(FOUR))
    family = F.initcap(F.concat(_syllables(syllables, seed, many), _longer(syllables, seed, attempt)))
    return out.when(kind.startswith("given"), F.concat(given, _longer(syllables, seed, attempt))).otherwise(family)


def _space(kind: Column) -> Column:
    """Entities of one space have distinct surrogates: given names of a script are one, whatever the gender."""
    return F.regexp_replace(kind, "^given_[mfu]", "given")


def persons(entities: DataFrame) -> DataFrame:
    """``kind, canon, person`` of the distinct ``kind, canon``: the kind with the person's gender.

    A person under a form of address for both genders (Dr) has the gender of the others; only
    where they tell both, or none, it stays apart. ``person`` is ``kind`` for all else.
    """
    same = Window.partitionBy(_space(F.col("kind")), "canon")
    m, f = (F.max(F.col("kind").startswith(f"given_{g}")).over(same) for g in "mf")
    told = F.when(m & ~f, "m").when(f & ~m, "f").otherwise("u")
    kind = F.col("kind")
    return entities.distinct().select("kind", "canon", F.when(kind.startswith("given_u"), F.concat(F.lit("given_"), told, F.substring(kind, 8, 1))).otherwise(kind).alias("person"))


def _full(entities: DataFrame) -> list[str]:
    """The spaces of fixed length that have no place for every entity: nothing can be distinct and unreal there."""
    sizes = entities.where(F.col("kind").isin("ip", "phone", "ssn", "card")).groupBy("kind", F.when(F.col("kind") != "ip", F.length("canon")).alias("digits")).count().collect()
    return [f"{r['count']} of {r.kind} {r.digits or ''}" for r in sizes if (r["count"] > 254**4 if r.kind == "ip" else 2 * r["count"] > 10**r.digits)]


def mapping(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canon, attempt`` with distinct surrogates for the distinct ``kind, canon`` given.

    The ``canon`` of a given name is the whole name. Persons of one family name share its
    surrogate, so their given names have distinct ones, none of them that of a real person of
    the family name. Names and local parts of addresses grow until all are distinct; a number
    keeps its length, so rounds go on as long as its space has room.
    """
    # entities never equal a surrogate of their kind, so a text never shows another's real data
    known = entities.select(_space(F.col("kind")).alias("_space"), F.col("canon").alias("_s")).distinct()
    now = materialize(entities.distinct().withColumn("attempt", F.lit(0)), "pii-mapping")
    for attempts in count(1):
        drawn = now.withColumn("_new", render(F.col("kind"), F.col("canon"), F.col("canon"), F.col("attempt"), key)).withColumn("_space", _space(F.col("kind")))
        person = F.when(F.col("_space").startswith("given"), F.concat_ws(" ", "_new", F.substring_index("canon", " ", -1))).otherwise(F.col("_new"))
        own = drawn.select("kind", "canon", "attempt", "_space", _canonical(F.col("kind"), person).alias("_s"))
        real = known.withColumn("_real", F.lit(True))
        nth = F.row_number().over(Window.partitionBy("_space", "_s").orderBy("attempt", "canon", "kind"))
        tested = own.withColumn("_n", nth).join(real, ["_space", "_s"], "left")
        clash = (F.col("_n") > 1) | F.coalesce(F.col("_real"), F.lit(False))
        now = materialize(tested.select("kind", "canon", "attempt", clash.alias("_clash")), "pii-mapping")
        if now.where("_clash").isEmpty():
            return now.select("kind", "canon", "attempt")
        now = now.select("kind", "canon", (F.col("attempt") + F.col("_clash").cast("int")).alias("attempt"))
        if attempts % ATTEMPTS == 0 and (full := _full(now)):
            raise ValueError(f"more entities than surrogates: {', '.join(full)}")


def replace(docs: DataFrame, key: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every entity of ``text_col`` replaced, and column ``n_entities long`` added.

    Rows and other columns stay (a column named ``n_entities`` is replaced); a null text
    stays null with 0 entities; an empty table gives an empty result. Only texts with an
    entity take part in any shuffle, and only once for each distinct text.
    """
    own = [c for c in docs.columns if c != "n_entities"]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    given = docs.select(F.struct(*[f"`{c}`" for c in own]).alias("row"), text.alias("text"))
    has = F.col("text").rlike(SOME) & F.col("text").rlike(ANY)
    back = lambda t: [t.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in own]
    rest = given.where(~has).select(*back(F.col("row")[text_col]), F.lit(0).cast("long").alias("n_entities"))
    hits = materialize(given.where(has).select("row", F.sha2("text", 256).alias("blob"), _segments(F.col("text")).alias("segments")), "pii-hits")
    # copies: any one of the equal segment lists
    parts = hits.select("blob", F.posexplode("segments").alias("at", "s")).select("blob", "at", "s.*").dropDuplicates(["blob", "at"])
    parts = materialize(parts, "pii-segments")
    who = materialize(persons(parts.where("kind IS NOT NULL").select("kind", "canon")), "pii-persons")
    attempts = who.join(mapping(who.select(F.col("person").alias("kind"), "canon"), key).withColumnRenamed("kind", "person"), ["person", "canon"])
    named = parts.where("kind IS NOT NULL").join(attempts, ["kind", "canon"]).select("blob", "at", render(F.col("person"), F.col("text"), F.col("canon"), F.col("attempt"), key).alias("out"), F.lit(1).alias("e"))
    whole = named.union(parts.where("kind IS NULL").select("blob", "at", F.col("text").alias("out"), F.lit(0).alias("e")))
    texts = whole.groupBy("blob").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "out"))), lambda x: x["out"]), "").alias("_new"), F.sum("e").alias("_n"))
    changed = hits.select("row", "blob").join(texts, "blob").select(*back(F.col("_new")), F.col("_n").alias("n_entities"))
    return rest.union(changed)
