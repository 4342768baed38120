"""Freely typed names mapped to a list of known ones: prefix-filter set-similarity join."""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.heteronyms import READINGS
from tidewell.operators import skew
from tidewell.session import cut, spread

#: Least Jaccard similarity of the token sets (characters and neighbouring pairs).
SIMILAR = 0.5
#: Bounds are compared with this much room, as 0.4 / 1.4 * 7 is a little over 2.
EPS = 1e-9
#: A list of up to so many names is sent to the tasks as an index; a longer one is joined by shuffle, with the same result.
SMALL_LIST = 20_000
#: Words to strip (cities, places, kinds) are sent to the tasks up to so many; more of them are joined to the values' parts, with the same result.
WORDS = 200_000
#: A word names a branch's place if it stands behind at least so many different names, in a bracket or behind a separator.
PLACE_HEADS = 20
#: Cores whose hits a worker keeps.
CACHE = 200_000
#: No character of several readings.
_ONE: dict[str, str] = {}

# Words around a name that say nothing about it.
NOISE = "商贸有限公司 餐饮管理有限公司 管理有限公司 食品有限公司 有限责任公司 有限公司 餐饮管理 旗舰店 品牌 官方 自营 直营 直营店 加盟 加盟店 连锁 连锁店 集团 实业 商贸 新开 外卖 牌 official coltd co ltd llc inc corp store".split()
_NOISE = frozenset(NOISE)
_PREFIX = regex.compile(r"^\s*(?:(?:brnd|brand|品牌|店名|名称)\s*[=:]\s*|[0-9]{1,2}[.、]\s*(?=\D))+")
_LABEL = regex.compile(r"(?:brnd|brand|品牌)\s*[=:]\s*")
_SEPARATOR = regex.compile(r"[\s()\[\]【】《》〈〉「」『』“”\"'’‘·・•/\\|、,，;；:：_.。…~!！?？*★☆#&+\-–—®™©]+")
_STRONG = regex.compile(r"[()\[\]【】《》「」“”\"·・•/\\|、\-–—]+")
_SYMBOL = regex.compile(r"[^\p{L}\p{N}]+")
_BRANCH = regex.compile(r"^(.*?)(?:\d+号?)?(?:分店|总店|店)?$")
_NUMBERED = regex.compile(r"^(.*?)(\d*号?(?:分店|总店|店)?)$")
_LISTED = regex.compile(r"^\d{1,2}(?=\D{3})")
_HAN = regex.compile(r"\p{Han}")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_SCRIPTS = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]+|[^\p{Han}\p{Hiragana}\p{Katakana}]+")
_DROPPED = regex.compile(r"[\p{Cf}\p{So}\p{Sk}\p{Mn}\p{Co}]+")


@dataclass
class Script:
    """Tables from code points: the simplified form of a Han character, and the character that stands for its sound.

    readings: characters of private use stand for a choice of readings; here they have the characters that stand for these, the first reading first.
    """

    simple: dict[int, str]
    sound: dict[int, str]
    readings: dict[str, str]

    def fold(self, text: str) -> str:
        """Level form of a text: width, case, composition, traditional characters; without signs and invisible characters."""
        if text.isascii():
            return _DROPPED.sub("", text).lower()
        text = _DROPPED.sub("", text)  # before ™ becomes letters
        text = unicodedata.normalize("NFKC", text).casefold()
        return _DROPPED.sub("", text).translate(self.simple)

    def sounds(self, core: str) -> str:
        """The core with characters of one sound written alike."""
        return core if core.isascii() else core.translate(self.sound)


_SCRIPT: list[Script] = []


def script(spark: SparkSession) -> Script:
    """The Unicode data on variants and readings that come with Spark's ICU library, for all Han characters of the basic plane; bounded by the script.

    Characters of one Mandarin reading sound alike, whatever the tone, as input methods ask for none. The library has the first reading of each
    character; those with several have the others from `heteronyms`. Made once a driver.
    """
    if not _SCRIPT:
        han = "".join(chr(c) for a, b in ((0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00)) for c in range(a, b) if unicodedata.category(chr(c)) == "Lo")
        of = spark.sparkContext._jvm.com.ibm.icu.text.Transliterator.getInstance
        simple, read = ("".join(of(name).transliterate("\n".join(han))).split("\n") for name in ("Hant-Hans", "Han-Latin; Latin-ASCII"))
        stands: dict[str, str] = {}
        for c, r in zip(han, read):
            if r != c:
                stands.setdefault(r, c)
        sound, choices = {ord(c): stands[r] for c, r in zip(han, read) if r != c}, {}
        for c, others in READINGS.items():
            choice = "".join(dict.fromkeys([sound[ord(c)], *sorted(stands[r] for r in others if r in stands)]))
            if len(choice) > 1:
                sound[ord(c)] = choices.setdefault(choice, chr(0xE000 + len(choices)))
        _SCRIPT.append(Script({ord(c): s for c, s in zip(han, simple) if s != c and len(s) == 1}, sound, {c: choice for choice, c in choices.items()}))
    return _SCRIPT[0]


def tokens(core: str, readings: Mapping[str, str] = _ONE) -> list[str]:
    """Characters and neighbouring pairs with the two ends marked, each with its count so far, as a set.

    2 n + 1 for n characters. One of several readings gives the tokens of all of them, so those of any choice are among them.
    """
    seen: dict[str, int] = {}
    out = []
    if readings.keys().isdisjoint(core):
        padded = f"^{core}$"
        every = [*core, *(padded[i : i + 2] for i in range(len(padded) - 1))]
    else:
        read = [readings.get(c, c) for c in core]
        every = [*"".join(read), *(a + b for x, y in zip(["^", *read], [*read, "$"]) for a in x for b in y)]
    for t in every:
        seen[t] = seen.get(t, 0) + 1
        out.append(t if seen[t] == 1 else f"{t} {seen[t]}")
    return out


class Words:
    """A set of words that a text may begin or end with, found by look-ups of its parts, the longest first."""

    def __init__(self, words: Iterable[str] = ()):
        self.words = frozenset(w for w in words if w)
        self.lengths = sorted({len(w) for w in self.words}, reverse=True)

    def __contains__(self, word: str) -> bool:
        return word in self.words

    def head(self, text: str, rest: int) -> str:
        """The longest word that text begins with, `rest` characters or more being left; '' without one."""
        return next((text[:n] for n in self.lengths if len(text) - n >= rest and text[:n] in self.words), "")

    def tail(self, text: str, rest: int) -> str:
        return next((text[-n:] for n in self.lengths if len(text) - n >= rest and text[-n:] in self.words), "")


_COMPANY = Words(NOISE)


def cores(folded: str, cities: Words, places: Words, kinds: Words) -> list[str]:
    """Forms of the name within a folded value, the likeliest first: without label, decoration, company words, city, branch and kind of shop."""
    s = _LABEL.sub(" ", _PREFIX.sub("", folded))

    def is_place(seg: str) -> bool:
        word = _BRANCH.match(seg)[1]
        return word in places or seg in places or word in cities or seg in cities or (word == "" and seg != "")

    def bare(seg: str) -> str:
        """Without place and company words at its ends."""
        while True:
            was = seg
            if city := cities.head(seg, 2):
                seg = seg[len(city) :].removeprefix("市")
                seg = _LISTED.sub("", seg[len(places.head(seg, 2)) :])  # a number of the list it was copied from
            while word := _COMPANY.tail(seg, 2):
                seg = seg[: -len(word)]
            if seg.isascii() is False and not _CJK.match(seg[:1] or "a") and (word := kinds.tail(seg, 3)):
                seg = seg[: -len(word)]
            tail = _NUMBERED.match(seg)
            if tail[2] and (word := places.tail(tail[1], 2)):
                seg = tail[1][: -len(word)]
            if seg == was:
                return seg

    out: list[str] = []

    def add(seg: str) -> None:
        seg = _SYMBOL.sub("", seg)
        if seg and seg not in out:
            out.append(seg)

    segs = [x for x in _SEPARATOR.split(s) if x]
    kept = [x for x in segs if x not in _NOISE and not is_place(x)]
    joined = "".join(kept)
    add(bare(joined))
    add(joined)
    parts = []
    for part in _STRONG.split(s):
        whole = "".join(x for x in _SEPARATOR.split(part) if x and x not in _NOISE and not is_place(x))
        parts.append(whole)
        parts += _SCRIPTS.findall(whole)
    for p in parts:
        if len(p) > 1:
            add(bare(p))
    add(_SYMBOL.sub("", s))
    return out


def edits(a: str, b: str) -> int:
    """Levenshtein distance."""
    if a == b:
        return 0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def read_alike(core: str, entry: str, readings: Mapping[str, str]) -> tuple[str, str, int]:
    """Both cores in the readings by which they agree, and how many characters aren't read by their first one.

    Characters that an alignment of the fewest edits puts together, and then those left over on both sides, take a reading that they share; others the first.
    """
    if readings.keys().isdisjoint(core) and readings.keys().isdisjoint(entry):
        return core, entry, 0
    a, b = ([readings.get(c, c) for c in x] for x in (core, entry))
    n, m = len(a), len(b)
    shared: dict[tuple[str, str], str] = {}
    for x in set(a):
        for y in set(b):
            if both := [r for r in x if r in y]:
                shared[x, y] = both[0]
    cost = [list(range(m + 1))]
    for i, x in enumerate(a, 1):
        row, last = [i], cost[-1]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + ((x, y) not in shared)))
        cost.append(row)
    pairs, left, right = [], [], []
    i, j = n, m
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + ((a[i - 1], b[j - 1]) not in shared):
            i, j = i - 1, j - 1
            if (a[i], b[j]) in shared:
                pairs.append((i, j))
            else:
                left.append(i)
                right.append(j)
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            left.append(i)
        else:
            j -= 1
            right.append(j)
    # those with the fewest partners choose first
    for i in sorted(left, key=lambda i: sum((a[i], b[j]) in shared for j in right)):
        if (j := next((j for j in right if (a[i], b[j]) in shared), None)) is not None:
            right.remove(j)
            pairs.append((i, j))
    c, e = [x[0] for x in a], [y[0] for y in b]
    for i, j in pairs:
        c[i] = e[j] = shared[a[i], b[j]]
    return "".join(c), "".join(e), sum(r != x[0] for r, x in zip(c + e, a + b))


def likeness(core: str, entry: str) -> float:
    """Jaccard similarity of the token sets."""
    a, b = set(tokens(core)), set(tokens(entry))
    return len(a & b) / len(a | b)


def one_slip(core: str, entry: str) -> bool:
    """Whether two cores are the same or differ by one typing slip: a character more, less or exchanged, or two in each other's place.

    One character exchanged in a short Chinese name makes another name.
    """
    d = edits(core, entry)
    if d == 0:
        return True
    same = len(core) == len(entry)
    if d > 1 and not (d == 2 and same and sorted(core) == sorted(entry)):
        return False
    least = (4 if same else 3) if _HAN.search(entry) else 5
    return min(len(core), len(entry)) >= least


class NameIndex:
    """The known names with their tokens by rarity; finds all names of Jaccard similarity `similar` by their rare prefixes."""

    def __init__(self, names: list[tuple], similar: float, readings: Mapping[str, str] = _ONE):
        self.names, self.similar, self.readings = names, similar, readings  # (ident, name, known, entry)
        sets = [tokens(n[3], readings) for n in names]
        freq: dict[str, int] = {}
        for s in sets:
            for t in s:
                freq[t] = freq.get(t, 0) + 1
        self.order = {t: k for k, t in enumerate(sorted(freq, key=lambda t: (freq[t], t)))}
        self.sets = [frozenset(s) for s in sets]
        self.sizes = [2 * len(n[3]) + 1 for n in names]
        self.plain = [readings.keys().isdisjoint(n[3]) for n in names]
        self.at: dict[str, list[tuple[int, int]]] = {}
        for k, s in enumerate(sets):
            for p, t in enumerate(sorted(s, key=self.order.__getitem__)[: self.prefix(len(s), self.sizes[k])]):
                self.at.setdefault(t, []).append((k, p))
        self.found: dict[str, list[tuple[int, float, str, str, int]]] = {}

    def prefix(self, tokens: int, size: int) -> int:
        """Of so many tokens, those of all readings, the rarest of which one must be shared; size: the tokens of one reading."""
        return tokens - math.ceil(size * self.similar - EPS) + 1

    def need(self, na: int, nb: int) -> float:
        """Tokens that two sets of these sizes must share; infinite if one is too long for the other."""
        if not na * self.similar - EPS <= nb <= na / self.similar + EPS:
            return math.inf
        return math.ceil(self.similar / (1 + self.similar) * (na + nb) - EPS)

    def search(self, core: str) -> list[tuple[int, float, str, str, int]]:
        """(number of the name, Jaccard, core and name in the readings by which they agree, characters not read by their first) of all names similar enough."""
        hits = self.found.get(core)
        if hits is not None:
            return hits
        mine = tokens(core, self.readings)
        na, plain = 2 * len(core) + 1, self.readings.keys().isdisjoint(core)
        known = sorted((t for t in mine if t in self.order), key=self.order.__getitem__)
        skip = len(mine) - len(known)  # tokens that the list doesn't have are the rarest of all
        seen: set[int] = set()
        needs: dict[int, float] = {}
        hits, whole, n = [], set(mine), len(mine)
        for p, t in enumerate(known[: max(0, self.prefix(len(mine), na) - skip)], skip):
            for k, q in self.at.get(t, ()):
                if k in seen:
                    continue
                nb = self.sizes[k]
                need = needs.get(nb)
                if need is None:
                    need = needs[nb] = self.need(na, nb)
                # before the two places at most min(p, q) tokens agree, from them on at most what the shorter rest holds
                if min(p, q) + min(n - p, len(self.sets[k]) - q) < need:
                    continue
                seen.add(k)
                common, entry = len(whole & self.sets[k]), self.names[k][3]
                if common < need:
                    continue
                if plain and self.plain[k]:
                    hit = (common / (na + nb - common), core, entry, 0)
                else:
                    c, e, others = read_alike(core, entry, self.readings)
                    hit = (likeness(c, e), c, e, others)
                if hit[0] >= self.similar - EPS:
                    hits.append((k, *hit))
        if len(self.found) >= CACHE:
            self.found.clear()
        self.found[core] = hits
        return hits


def _branch_places(values: DataFrame, value: str) -> DataFrame:
    """(w): words that stand behind at least PLACE_HEADS different names, in a bracket or behind a separator."""
    text = F.translate(F.col(value), "（）", "()")
    word = F.regexp_extract(text, r"[(·\- ]([\p{IsHan}]{2,6}?)(?:\d+号)?(?:分店|店)?\)?$", 1)
    head = F.lower(F.regexp_replace(F.regexp_extract(text, r"^(.*)[(·\- ][^(·\- ]*$", 1), r"[^\p{L}\p{N}]+", ""))
    pairs = values.select(word.alias("w"), head.alias("h")).where("w <> '' and h <> ''").distinct()
    return pairs.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= PLACE_HEADS).select("w")


def _parts_with_words(values: DataFrame, words: DataFrame, chars) -> DataFrame:
    """(value, words): for each value the words (role and word in one) among the parts of its folded form, by an equi-join; for more words than can be sent."""
    longest = words.agg(F.coalesce(F.max(F.length("w")), F.lit(1))).first()[0]

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for v in b["value"]:
                s = chars.value.fold(v)
                yield pd.DataFrame({"value": v, "w": sorted({s[i : i + n] for i in range(len(s)) for n in range(1, min(longest, len(s) - i) + 1)})})

    hits = values.mapInPandas(parts, "value string, w string").join(words, "w").groupBy("value").agg(F.collect_list(F.concat("role", "w")).alias("words"))
    return values.join(hits, "value", "left")


def _joined(left: DataFrame, right: DataFrame, similar: float, refine: bool, chars) -> DataFrame:
    """left (value, written, core, form) with the names (_i, name, known, entry, jaccard, others) of right similar to the core: the join by shuffle."""
    @F.pandas_udf("array<string>")
    def token_set(cs: pd.Series) -> pd.Series:
        return cs.map(lambda c: tokens(c, chars.value.readings))

    @F.pandas_udf("c string, e string, others int, jaccard double")
    def alike(cs: pd.Series, es: pd.Series) -> pd.DataFrame:
        """The cores in the readings by which they agree; with their Jaccard if one has several."""
        rows = [(*(r := read_alike(c, e, chars.value.readings)), None if r[:2] == (c, e) else likeness(*r[:2])) for c, e in zip(cs, es)]
        return pd.DataFrame(rows, columns=["c", "e", "others", "jaccard"]).astype({"jaccard": float})

    names = right.select("entry").distinct().select("entry", token_set("entry").alias("t"))
    rarity = names.select(F.explode("t").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))

    def prefixes(df: DataFrame, key: str, side: str) -> DataFrame:
        """The rarest tokens of each row with their places; tokens that the list doesn't have come before all. n: the tokens of one reading."""
        flat = df.select(key, F.explode("t").alias("t")).join(rarity, "t", "left")
        s = flat.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "t"))).alias("s")).select(key, F.col("s.t").alias("s"))
        size = F.length(key) * 2 + 1
        long = F.size("s") - F.ceil(size * F.lit(similar) - EPS).cast("int") + 1
        return s.select(key, size.alias(f"n_{side}"), F.col("s").alias(f"s_{side}"), F.posexplode(F.slice("s", F.lit(1), long)).alias(f"p_{side}", "t"))

    a = prefixes(left.select("core").distinct().select("core", token_set("core").alias("t")), "core", "a")
    b = prefixes(names, "entry", "b")
    na, nb = F.col("n_a"), F.col("n_b")
    need = F.ceil(F.lit(similar / (1 + similar)) * (na + nb) - EPS)
    joined = a.join(b, "t").where((nb >= na * similar - EPS) & (nb <= na / similar + EPS))
    # before the two places at most min(p_a, p_b) tokens agree, from them on at most what the shorter rest holds
    joined = joined.where(F.least("p_a", "p_b") + F.least(F.size("s_a") - F.col("p_a"), F.size("s_b") - F.col("p_b")) >= need)
    joined = joined.withColumn("common", F.size(F.array_intersect("s_a", "s_b"))).where(F.col("common") >= need)
    pairs = joined.select("core", "entry", "n_a", "n_b", "common").distinct().withColumn("u", alike("core", "entry"))
    jaccard = F.coalesce("u.jaccard", F.col("common") / (na + nb - F.col("common")))
    scored = pairs.select("core", "entry", "u.c", "u.e", "u.others", jaccard.alias("jaccard")).where(F.col("jaccard") >= similar - EPS)
    if refine:
        distance = F.levenshtein("c", "e")
        letters = lambda c: F.array_sort(F.split(c, ""))
        same = F.length("c") == F.length("e")
        length = F.least(F.length("c"), F.length("e"))
        enough = F.when(F.col("e").rlike(r"\p{IsHan}"), F.when(same, length >= 4).otherwise(length >= 3)).otherwise(length >= 5)
        scored = scored.where((distance == 0) | (((distance == 1) | ((distance == 2) & same & (letters("c") == letters("e")))) & enough))
    scored = scored.select("core", "entry", "others", "jaccard")
    matches = cut(scored.join(right, "entry"), "matches")
    # the values of a popular name are split over tasks, its few matches copied to these
    return skew.balanced_join(left, matches, skew.plan_load(left, "core"), "value", "inner")


def map_values(values: DataFrame, value: str, listed: DataFrame, ident: str, names: list[str], cities: DataFrame | None = None, kind: str | None = None, places: DataFrame | None = None, similar: float = SIMILAR, refine: bool = True) -> DataFrame:
    """(value, ident, name, jaccard): one row for each different value; ident is null where the list doesn't hold it.

    value is the text as stored. Nulls and blanks are left out; repeated values give one row. An entry is known by any of the columns `names`.
    cities: a one-column table of words that may precede a name. kind: a column of the list with words that may follow a name. places: a one-column
    table of words that name a branch; without it, words behind at least PLACE_HEADS different names are taken. An empty list leaves all values without entry.

    Tokens are ordered by their rarity in the list; two sets of Jaccard similarity
    `similar` must share a token of their rarest prefixes, so only those are joined. A character of several readings has the tokens of each.
    Candidates then pass the length and the positional filter and an exact Jaccard test. The best Jaccard stays, on ties the whole form before parts, the
    fewest written differences, the fewest other readings than the first, the longer name, the smaller ident. refine (optional): only names that differ by one typing slip are candidates.

    A list of up to SMALL_LIST names goes to the tasks as an index, so values are not shuffled by their content and no name can be hot; a
    longer list is joined by shuffle, with the values of hot names split over tasks (see skew.balanced_join).
    """
    spark = values.sparkSession
    distinct = values.select(F.col(value).alias("value")).where(F.col("value").isNotNull() & F.col("value").rlike(r"(?U)\S")).distinct()
    distinct = cut(distinct, "typed")
    chars = spark.sparkContext.broadcast(script(spark))
    one = lambda df, role: df.select(F.lit(role).alias("role"), F.col(df.columns[0]).cast("string").alias("w"))
    raw = one(places if places is not None else _branch_places(distinct, "value"), "p")
    for df, role in ((cities, "c"), (listed.select(kind) if kind else None, "k")):
        raw = raw.unionByName(one(df, role)) if df is not None else raw

    def level(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            w = [chars.value.fold(x) for x in b["w"]]
            b["w"] = [x.removesuffix("市") if r == "c" else x for r, x in zip(b["role"], w)]
            yield b[(b["w"] != "") & ((b["role"] != "p") | (b["w"].str.len() > 1))]

    words = raw.where("w is not null").distinct().mapInPandas(level, "role string, w string").distinct()
    some = [r[0] + r[1] for r in words.limit(WORDS + 1).collect()]
    typed = spread(distinct, "value")
    if len(some) > WORDS:
        typed, some = _parts_with_words(distinct, cut(words, "words"), chars), None
    sent = spark.sparkContext.broadcast(some)
    role = lambda ws, r: Words(w[1:] for w in ws if w[0] == r)

    def forms_of(b: pd.DataFrame) -> Iterator[tuple[str, list[str]]]:
        """Each value with the forms of its name."""
        for k, v in enumerate(b["value"]):
            if k == 0 or sent.value is None:
                mine = sent.value if sent.value is not None else b["words"].iloc[k] if b["words"].iloc[k] is not None else []
                sets = [role(mine, r) for r in "cpk"]
            yield v, cores(chars.value.fold(v), *sets)

    def plain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, n, c, chars.value.sounds(c)) for i, n in zip(b["_i"], b["name"]) if (c := _SYMBOL.sub("", chars.value.fold(n)))]
            yield pd.DataFrame(rows, columns=["_i", "name", "known", "entry"])

    id_type = listed.schema[ident].dataType.simpleString()
    entries = listed.select(F.col(ident).alias("_i"), F.explode(F.array(*names)).alias("name")).where("name is not null and _i is not null").distinct()
    right = entries.mapInPandas(plain, f"_i {id_type}, name string, known string, entry string")
    known = [tuple(r) for r in right.limit(SMALL_LIST + 1).collect()]
    out = f"value string, _i {id_type}, name string, jaccard double"
    if len(known) <= SMALL_LIST:
        index = spark.sparkContext.broadcast(known)

        def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index_here = NameIndex(index.value, similar, chars.value.readings)
            for b in batches:
                rows = []
                for v, forms in forms_of(b):
                    top = None
                    for k, c in enumerate(forms):
                        core = chars.value.sounds(c)
                        for n, jaccard, mine, entry, others in index_here.search(core):
                            i, name, written, _ = index_here.names[n]
                            if (top is not None and jaccard < top[0][0]) or (refine and not one_slip(mine, entry)):
                                continue
                            rank = (jaccard, -k, -edits(c, written), -others, len(entry))
                            if top is None or rank > top[0] or (rank == top[0] and i < top[1]):
                                top = (rank, i, name)
                    rows.append((v, top[1], top[2], top[0][0]) if top else (v, None, None, None))
                yield pd.DataFrame(rows, columns=["value", "_i", "name", "jaccard"]).astype({"_i": object})

        best = typed.mapInPandas(look_up, out)
        return best.select(F.col("value").alias(value), F.col("_i").alias(ident), "name", "jaccard")

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(v, c, chars.value.sounds(c), k) for v, fs in forms_of(b) for k, c in enumerate(fs)]
            yield pd.DataFrame(rows, columns=["value", "written", "core", "form"])

    left = cut(typed.mapInPandas(forms, "value string, written string, core string, form int"), "forms")
    right = cut(right, "entries")
    hits = _joined(left, right, similar, refine, chars)
    order = F.struct((-F.col("jaccard")).alias("j"), "form", F.levenshtein("written", "known").alias("slips"), "others", (-F.length("entry")).alias("n"), "_i")
    best = hits.groupBy("value").agg(F.min_by(F.struct("_i", "name", "jaccard"), order).alias("hit"))
    return distinct.join(best, "value", "left").select(F.col("value").alias(value), F.col("hit._i").alias(ident), "hit.name", "hit.jaccard")
