import html
import re

from pyspark.sql import functions as F

from signmine.functions import captions as cap
from signmine.functions import naming, planning

WORDS = re.compile(rf"\b(?:{'|'.join(cap.VISIBLE_TEXT_WORDS)})\b", re.I)
QUOTED = re.compile("[\"“][^\"“”\\n]+[\"”]|(?<!\\w)['‘][^'‘’\\n]+['’](?!\\w)")
ODD = [
    "", '"', '""', "”x“", '"a\nb"', "it's John's", "5'10' tall", "é'hi'é", "text́", "²text", "text½", "字text", "ſays", "INSCRİPTION", "inscrıptıon", "context", "_text_", "rock 'n' roll",
    'A sign that READS "stop" & \'go\'', "“one” and ‘two’", "titled 'x' titled", "<b>text</b> & \"q\"", "words words", '"word" in a "text"', "'a' 'b'", '"nested \'inner\' quote"', "plain photo",
]


def spans_of(s):
    found = sorted([(m.start(), m.end(), "q") for m in QUOTED.finditer(s)] + [(m.start(), m.end(), "v") for m in WORDS.finditer(s)])
    kept, last = [], 0
    for x in found:
        if x[0] >= last:
            kept.append(x)
            last = x[1]
    return found, kept


def shown(s):
    out, at = "", 0
    for a, b, kind in spans_of(s)[1]:
        out += html.escape(s[at:a]) + f'<span class="hl-{kind}">{html.escape(s[a:b])}</span>'
        at = b
    return out + html.escape(s[at:])


def test_predicate_spans_and_highlights_are_those_of_python(spark):
    rows = spark.createDataFrame([(s,) for s in ODD], "s string")
    both = F.array_sort(F.concat(cap.quoted_spans(F.col("s")), cap.word_spans(F.col("s"))))
    for row in rows.select("s", cap.speaks_of_text(F.col("s")).alias("p"), both.alias("spans"), cap.highlight(F.col("s")).alias("html")).collect():
        s = row["s"]
        assert row["p"] == bool(WORDS.search(s) or QUOTED.search(s)), s
        assert [tuple(x) for x in row["spans"]] == spans_of(s)[0], s
        assert row["html"] == shown(s), s


def test_null_captions(spark):
    row = spark.createDataFrame([(None,)], "s string").select(cap.speaks_of_text(F.col("s")).alias("p"), F.size(cap.word_spans(F.col("s"))).alias("n"), cap.highlight(F.col("s")).alias("h")).first()
    assert tuple(row) == (False, 0, "")


def test_names(spark):
    assert naming.run_suffix() == "" and naming.run_suffix(1_000_000, 20, 4, 3, True) == "_t1M_k20_w03_fp16" and naming.run_suffix(1500) == "_t1500"
    assert naming.timeout_pair("3") == (3.0, 3.0) and naming.timeout_pair("3,5") == (3.0, 5.0)
    row = spark.range(1).select(
        naming.store_key(F.lit(7)).alias("a"), naming.crop_name(F.lit("s"), F.lit(12), F.lit(3)).alias("b"), naming.readable_seconds(F.lit(59.94)).alias("c"), naming.readable_seconds(F.lit(4500.0)).alias("d"),
        naming.base64_of(F.lit("x" * 200).cast("binary")).alias("e"), naming.short_count(F.lit(2_000_000_000).cast("long")).alias("f"), naming.looks_like_image(F.lit(None).cast("string"), F.lit("http://a/b.PNG?x")).alias("g"),
    ).first()
    assert row[:4] == ("image-000000007", "s__r00000012__c03", "59.9s", "1.25h (4500s)")
    assert "\n" not in row["e"] and len(row["e"]) == 268 and row["f"] == "2B" and row["g"] is True


def test_planning(spark):
    row = spark.range(1).select(planning.shown_fetch_cap(F.lit(1000)).alias("a"), planning.fetch_cap(F.lit(1000)).alias("b"), planning.chunk_size(F.lit(100_000)).alias("c"), planning.chunk_size(F.lit(3_000_000)).alias("d")).first()
    assert tuple(row) == (420, 417, 0, 100_000)
    assert planning.fetch_cap_of(1000) == 417 and planning.fetch_cap_of(0) == 1 and planning.fetch_cap_of(7, 0.0, 0.0, 0.0) == 1400
    assert planning.chunk_target(0, 30) == 30 and planning.chunk_target(10, 30) == 10 and planning.chunk_target(10, None) == 10
    assert planning.expected_yield(0) == 12 and planning.expected_yield(10) == 5 and planning.preview_workers(32, 10, 0) == 1
