"""Operator 5: secrets in text, by fixed patterns and by a battery of randomness tests. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signmine.functions.arrays import bound, scan, spans
from signmine.llm.common import cut

# The contract's patterns.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]+"
#: Hex runs of 24 or more: the leftmost match of this is the whole run, as with the contract's `[0-9a-f]+` and its length.
HEX = r"[0-9a-f]{24,}"

#: A string that the tests look at: a whole run of 20 or more such characters, a digit and a letter among them.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}"
#: Share of the added strings that may be written ones and not random, in the long run (Benjamini-Hochberg).
FDR = 0.05
#: Lengths of the classes that the rate is kept within; strings of the last may be longer.
CLASSES = ((20, 24), (24, 32), (32, 48), (48, 96), (96, 200))
#: Characters of a passage, whose words are put together in one way; a text is cut into passages from end to end.
PASSAGE = 400
#: p-values are counted in so many bins of equal width in -log10 p, so that the ranks need no sort of all strings.
BINS, BINS_PER_DECADE = 320, 20
#: Alphabets in the order in which one is inferred. Characters stand in the order of their value.
ALPHABETS = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^.*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)

#: Strings of so many symbols or fewer have their sums in one number: above the last symbol's six bits stand (lowest bit, bits) the sums of symbols, of their squares and of neighbours' products.
SHORT, PACKED = 512, ((6, 15), (21, 21), (42, 21))
#: The least p-value that is told apart.
FLOOR = 1e-16


def _packed(alphabet: str) -> list[int]:
    """For each ASCII code the character's value c in the alphabet and what it adds to the first two sums, as one number: c, and c and its square at their places in PACKED. 0 for other characters."""
    return [c + (c << PACKED[0][0]) + (c * c << PACKED[1][0]) for c in (max(0, alphabet.find(chr(i))) for i in range(128))]


def _then(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once, as with bound(), but not copied: an aggregate of nothing hands its first state to its end."""
    return F.aggregate(F.expr("cast(array() as array<int>)"), value, lambda acc, _: acc, use)


def _normal_tail(z: Column) -> Column:
    """P(Z > z), by the logistic form 1 / (1 + exp(1.5976 z + 0.07056 z^3)), within 0.00015."""
    return 1.0 / (1.0 + F.exp(F.least(F.lit(300.0), 1.5976 * z + 0.07056 * z * z * z)))


def battery(body: Column) -> Column:
    """Tests of one string against a uniform draw from its inferred encoding's alphabet: struct (encoding, n, p).

    p is Bonferroni's least of three: chi-squared uniformity over the alphabet (too uneven), the Wald-Wolfowitz runs test on lower and
    upper halves of the alphabet (too few or too many runs), and lag-1 serial correlation of the symbols' values (either way).
    """
    which = F.lit(None).cast("int")
    for i, (_, pattern, _) in reversed([*enumerate(ALPHABETS)]):
        which = F.when(body.rlike(pattern), F.lit(i)).otherwise(which)

    zero = F.lit(0).cast("bigint")
    code = lambda v: v.bitwiseAND(F.lit(63))
    of = lambda x, values: F.element_at(F.array(*map(F.lit, values)), x["i"] + 1)

    def coded(i: Column) -> Column:
        plain = F.when((i == 0) | (i == 2), F.lower(body)).otherwise(F.replace(F.replace(body, F.lit("_"), F.lit("/")), F.lit("-"), F.lit("+")))
        return F.struct(i.alias("i"), plain.alias("plain"), F.split(plain, "").alias("signs"))

    def uneven(x: Column) -> Column:
        """The chi-squared test, by the count of each symbol that occurs."""
        counts = F.transform(F.array_distinct(x["signs"]), lambda c: F.size(x["signs"]) - F.octet_length(F.replace(x["plain"], c, F.lit(""))))
        squares = F.aggregate(counts, zero, lambda acc, c: acc + c * c.cast("bigint")).cast("double")
        k, n = of(x, [float(len(a)) for _, _, a in ALPHABETS]), F.size(x["signs"]).cast("double")

        def chi(s: Column) -> Column:
            return (s["k"] / s["n"] * s["squares"] - s["n"] - (s["k"] - 1)) / F.sqrt(2.0 * (s["k"] - 1) * (s["n"] - 1) / s["n"])

        p = _then(_then(F.struct(k.alias("k"), n.alias("n"), squares.alias("squares")), chi), _normal_tail)
        return F.struct(*[x[c].alias(c) for c in ("i", "plain", "signs")], n.alias("n"), p.alias("chi"))

    def parts(x: Column) -> Column:
        """The symbols' packed values, and the runs of the alphabet's upper half."""
        values, upper = F.lit(None).cast("array<bigint>"), F.lit(None).cast("array<string>")
        for i, (_, _, alphabet) in enumerate(ALPHABETS):  # each with its own constants, which are made once
            table, half = F.array(*map(F.lit, _packed(alphabet))), f"[{alphabet[len(alphabet) // 2 :]}]+"
            values = F.when(x["i"] == i, F.transform(x["signs"], lambda c: F.get(table, F.ascii(c)))).otherwise(values)  # noqa: B023
            upper = F.when(x["i"] == i, F.regexp_extract_all(x["plain"], F.lit(half), F.lit(0))).otherwise(upper)
        return F.struct(x["i"].alias("i"), x["n"].alias("n"), values.alias("values"), upper.alias("upper"))

    def sums(x: Column) -> Column:
        """Sums over the symbols, their neighbours and halves; a state that is one number is far cheaper than a struct."""
        total = lambda of: F.aggregate(x["values"], zero, lambda acc, v: acc + of(code(v)))
        pairs = F.aggregate(x["values"], zero, lambda acc, v: acc + code(acc) * (code(v) * 64 - 1) + code(v), lambda acc: F.shiftright(acc, 6))
        one = F.aggregate(
            x["values"], zero, lambda acc, v: acc + v + code(acc) * (F.shiftleft(code(v), PACKED[2][0]) - 1),
            lambda acc: F.array(*[F.shiftright(acc, at).bitwiseAND(F.lit(2**bits - 1)) for at, bits in PACKED]),
        )
        each = F.when(F.size(x["values"]) <= SHORT, one).otherwise(F.array(total(lambda c: c), total(lambda c: c * c), pairs))
        first, last = (code(F.get(x["values"], at)) for at in (F.lit(0), F.size(x["values"]) - 1))
        # A run of the upper half has a change before it and one after it, but for the string's ends.
        ends = [F.when(e >= of(x, [len(a) // 2 for _, _, a in ALPHABETS]), 1).otherwise(0) for e in (first, last)]
        changes = 2 * F.size(x["upper"]) - ends[0] - ends[1]
        return _then(each, lambda s: F.struct(
            x["n"].alias("n"), *[F.get(s, at).cast("double").alias(c) for at, c in enumerate(("s", "q", "pairs"))],
            F.octet_length(F.array_join(x["upper"], "")).cast("double").alias("upper"), changes.cast("double").alias("changes"), (first + last).cast("double").alias("ends"),
        ))

    def scores(x: Column) -> Column:
        n = x["n"]
        n1, n2 = x["upper"], n - x["upper"]
        spread = 2.0 * n1 * n2 * (2.0 * n1 * n2 - n) / (n * n * (n - 1))
        runs = F.when(spread > 0, F.abs(x["changes"] - 2.0 * n1 * n2 / n) / F.sqrt(spread)).otherwise(F.lit(9.0))
        mean, var = x["s"] / n, x["q"] - x["s"] * x["s"] / n
        cov = x["pairs"] - mean * (2.0 * x["s"] - x["ends"]) + (n - 1) * mean * mean
        corr = F.when(var > 0, F.abs(cov / var + 1.0 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
        return F.array(runs, corr)

    def least(x: Column) -> Column:
        both = x
        for step in (parts, sums, scores):
            both = _then(both, step)
        rest = _then(both, lambda z: 2.0 * F.least(*[_normal_tail(F.get(z, i)) for i in (0, 1)]))
        # The other two can't take p below its floor, so they are left where the first alone has it there.
        p = F.when(3.0 * x["chi"] <= FLOOR, F.lit(FLOOR)).otherwise(F.greatest(F.least(F.lit(1.0), 3.0 * F.least(x["chi"], rest)), F.lit(FLOOR)))
        return F.struct(of(x, [e for e, _, _ in ALPHABETS]).alias("encoding"), x["n"].cast("int").alias("n"), p.alias("p"))

    out = which
    for step in (coded, uneven, least):
        out = _then(out, step)
    return out


def length_class(n: Column) -> Column:
    out = F.lit(len(CLASSES) - 1)
    for i, (_, end) in reversed([*enumerate(CLASSES)][:-1]):
        out = F.when(n < end, i).otherwise(out)
    return out


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(p) * BINS_PER_DECADE), F.lit(BINS)).cast("int")


def written(text: Column, key: Column) -> Column:
    """Strings as people write them, made of all of a document's own words, as array<string>: each letter of the text stands in one of them.

    The text is cut into passages, and each passage from end to end into strings, one for each length class as far as it reaches; the last takes the rest. A text of fewer letters than a string has gives none.
    key, a hash, and the passage say how the words are put together (as names, paths and slugs are: run together, capitalised, in capitals, by -, _ or /), to which
    lengths, and which digits, one to four, end or part them.
    """
    least = CLASSES[0][0]
    plain = F.trim(F.regexp_replace(text, "[^A-Za-z]+", " "))
    # What is left at the end joins the passage before, unless it is enough for a string: of single spaces and letters, half are letters.
    passages = F.regexp_extract_all(plain, F.lit(f".{{{PASSAGE},{PASSAGE + 2 * least}}}$|.{{1,{PASSAGE}}}"), F.lit(0))

    def joined(passage: Column, place: Column) -> Column:
        return _then(F.struct(F.xxhash64(passage, place, key).alias("key"), F.trim(passage).alias("plain")), lambda x: _then(styled(x["plain"], x["key"]), made))

    def styled(words: Column, key: Column) -> Column:
        odd = lambda salt, n: F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(n)).cast("int")
        style = odd(1, 4)
        cased = F.when(style == 0, F.lower(words)).when(style == 1, F.upper(words)).when(style == 2, F.initcap(words)).otherwise(words)
        body = F.replace(cased, F.lit(" "), F.element_at(F.array(*map(F.lit, ("", "", "", "-", "_", "/"))), odd(2, 6) + 1))
        drawn = F.lpad(F.conv(F.hex(F.xxhash64(key, F.lit(3))), 16, 10), 20, "7")
        digits = [F.substring(drawn, F.lit(4 * i + 1), F.pmod(key, F.lit(3 + i)).cast("int") % 4 + 1) for i in range(len(CLASSES))]
        sizes = [low + F.pmod(F.shiftright(key, 7 * i), F.lit(high - low)).cast("int") for i, (low, high) in enumerate(CLASSES)]
        return F.struct(key.alias("key"), body.alias("body"), F.length(body).alias("length"), F.array(*digits).alias("digits"), F.array(*sizes).alias("sizes"))

    def made(x: Column) -> Column:
        out, at = [], F.lit(1)
        for i in range(len(CLASSES)):
            digits, rest = x["digits"][i], x["length"] - at + 1
            own = x["sizes"][i] - F.length(digits)
            n = F.when(rest - own >= least, own).otherwise(rest) if i + 1 < len(CLASSES) else rest
            half = F.when(F.pmod(F.shiftright(x["key"], i), F.lit(2)) == 0, n).otherwise(F.floor(n / 2).cast("int"))
            whole = F.concat(F.substring(x["body"], at, half), digits, F.substring(x["body"], at + half, n - half))
            out.append(F.when(rest + (0 if i else F.length(digits)) >= least, whole))
            at = at + own
        return F.filter(F.array(*out), lambda s: s.isNotNull())

    return F.flatten(F.transform(passages, joined))


def _named(place: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), s["end"].alias("end"))


def apart(found: Column, base: Column) -> Column:
    """Those of the spans found (start, end, body) that share no place with a base span (start, end): in order of start, from the left past the furthest end so far, and from the right past the next start."""
    kind = "struct<start:int,of:int,end:int,body:string,hit:boolean>"

    def marked(x: Column, hit: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in ("start", "of", "end", "body")], hit.alias("hit"))

    def forward(furthest: Column, x: Column) -> tuple[Column, Column]:
        return F.when(x["of"] == 0, F.greatest(furthest, x["end"])).otherwise(furthest), marked(x, furthest > x["start"])

    def backward(following: Column, x: Column) -> tuple[Column, Column]:
        return F.when(x["of"] == 0, x["start"]).otherwise(following), marked(x, x["hit"] | (following < x["end"]))

    both = F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("of"), s["end"].alias("end"), F.lit("").alias("body"))),
        F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("of"), s["end"].alias("end"), s["body"].alias("body"))),
    )
    swept = scan(F.reverse(scan(F.sort_array(both), F.lit(-1), forward, kind)), F.lit(2**31 - 1), backward, kind)
    rest = F.transform(F.filter(F.reverse(swept), lambda x: (x["of"] == 1) & ~x["hit"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["body"].alias("body")))
    return F.when((F.size(base) == 0) | (F.size(found) == 0), found).otherwise(rest)


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, base, tested, written) for each row: base spans (kind, start, end) in order; the strings of TOKEN's form that lie in none of them (start, end, encoding, n, p); and the battery's results for written() strings."""
    text = F.coalesce("text", F.lit(""))
    kinds = (("assign", ASSIGN, lambda s: F.length(F.regexp_extract(s["body"], VALUE, 1)) >= 6), ("access", ACCESS, lambda s: F.length(s["body"]) >= 20), ("hex", HEX, lambda s: F.length(s["body"]) >= 24))
    named = [F.transform(F.filter(spans(F.col("__text"), pattern), good), _named(i, kind)) for i, (kind, pattern, good) in enumerate(kinds)]
    rest = bound(F.struct(spans(F.col("__text"), TOKEN).alias("found"), F.col("base").alias("base")), lambda x: apart(x["found"], x["base"]))
    tested = F.transform(rest, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), battery(s["body"]).alias("test")))
    null = F.transform(written(F.col("__text"), F.xxhash64("__text")), lambda s: battery(s))
    found = docs.select("doc_id", text.alias("__text")).withColumn("base", F.sort_array(F.concat(*named)))
    return found.select("doc_id", "base", tested.alias("tested"), null.alias("written"))


def thresholds(looked_at: DataFrame, fdr: float = FDR) -> DataFrame:
    """For each length class and encoding, the greatest bin of p-values up to which strings are taken as random: class, encoding, bin (none: no row).

    The hypothesis of each string is that it is written. Its chance to be of that encoding and to look at least so random is counted over the written strings of all documents. By
    Benjamini-Hochberg, m times that chance over the number of strings found so is the share of false ones: bins are taken while it is fdr or less. Classes
    are apart, so that many short strings, whose tests tell little, don't decide about long ones, and short ones are only added where random ones abound. To the count of written strings come
    two of its standard errors, as strings of one passage are put together alike and tell less than as many independent ones, and one, so little text adds nothing. Counts by class, encoding and bin meet, 5 x 4 x 321 rows at most.
    """
    def counted(column: str, name: str) -> DataFrame:
        one = looked_at.select(F.explode(column).alias("t")).select("t.test.*" if column == "tested" else "t.*")
        return one.groupBy(length_class(F.col("n")).alias("class"), "encoding", _bin(F.col("p")).alias("bin")).agg(F.count("*").alias(name))

    both = counted("tested", "found").join(counted("written", "null"), ["class", "encoding", "bin"], "full")
    upto = Window.partitionBy("class", "encoding").orderBy("bin")
    whole = Window.partitionBy("class")
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    ranked = both.select("class", "encoding", "bin", total("found", upto).alias("found"), total("null", upto).alias("null"), total("found", whole).alias("m"), total("null", whole).alias("all"))
    false = F.col("m") * (F.col("null") + 2.0 * F.sqrt("null") + 1) / (F.col("all") + 1)
    return ranked.where((F.col("found") > 0) & (false <= fdr * F.col("found"))).groupBy("class", "encoding").agg(F.max("bin").alias("bin"))


def _level(levels: dict[tuple[int, str], int], test: Column) -> Column:
    found = F.lit(-1)
    for (kind, encoding), most in levels.items():
        found = F.when((length_class(test["n"]) == kind) & (test["encoding"] == encoding), F.lit(most)).otherwise(found)
    return found


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """A row for each row of docs: doc_id, base, added, arrays of structs (kind, start, end) in order of start.

    Base spans follow the fixed patterns. `added` are the strings of TOKEN's form, in no base span, that look more random to the battery than strings written of the documents' own words do, with
    the share of written ones among them held to fdr within length classes and encodings, over the whole corpus; their kind is random_ and the encoding.
    Null text counts as empty; an empty text has no spans; repeated rows count each; an empty table gives no rows; other columns play no part.
    """
    looked_at = cut(scanned(docs))
    levels = {(row["class"], row["encoding"]): row["bin"] for row in thresholds(looked_at, fdr).collect()}  # twenty rows at most
    random = F.filter("tested", lambda t: _bin(t["test"]["p"]) <= _level(levels, t["test"]))
    return looked_at.select(
        "doc_id",
        F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("base"),
        F.transform(random, lambda t: F.struct(F.concat(F.lit("random_"), t["test"]["encoding"]).alias("kind"), t["start"].alias("start"), t["end"].alias("end"))).alias("added"),
    )


def _line(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of what find_secrets() returns. Spans that start together stand in the order assign, access, hex, then added ones."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    place = lambda s: F.coalesce(F.array_position(F.array(*map(F.lit, ("assign", "access", "hex"))), s["kind"]), F.lit(0))
    keyed = F.sort_array(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), F.when(place(s) == 0, F.lit(9)).otherwise(place(s)).alias("place"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(_line(F.col("base")), 256).alias("base_sha256"), _line(keyed).alias("spans"))
