"""English stems, stored forms and stemmed lexicons."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from statuta.functions.english import english_stem
from statuta.functions.tokeniser import ALL_STEMMERS, tokenise
from statuta.operators import search
from statuta.plans import registry
from tests.test_words import FOLDER, documents

#: Words and stems of the published sample vocabulary.
SAMPLE = """consign consign consigned consign consigning consign consignment consign consist consist consisted consist consistency consist
consistent consist consistently consist consisting consist consists consist consolation consol consolations consol consolatory consolatori
console consol consoled consol consoles consol consolidate consolid consolidated consolid consolidating consolid consoling consol
consolingly consol consols consol consonant conson consort consort consorted consort consorting consort conspicuous conspicu
conspicuously conspicu conspiracy conspiraci conspirator conspir conspirators conspir conspire conspir conspired conspir conspiring conspir
constable constabl constables constabl constance constanc constancy constanc constant constant knack knack knackeries knackeri knacks knack
knag knag knave knave knaves knave knavish knavish kneaded knead kneading knead knee knee kneel kneel kneeled kneel kneeling kneel
kneels kneel knees knee knell knell knelt knelt knew knew knick knick knif knif knife knife knight knight knightly knight knights knight
knit knit knits knit knitted knit knitting knit knives knive knob knob knobs knob knock knock knocked knock knocker knocker knockers knocker
knocking knock knocks knock knopp knopp knot knot knots knot""".split()
RULES = "caresses caress ties tie cries cri gas gas this this gaps gap kiwis kiwi luxuriated luxuri hopping hop hoping hope bleed bleed agreed agre cry cri by by say say generally general communism communism skies sky dying die news news proceed proceed exceeding exceed yes yes youth youth boy boy relational relat hopefulness hope analogy analog falling fall be be beds bed shred shred".split()


@pytest.mark.parametrize(("word", "stem"), list(zip(SAMPLE[::2], SAMPLE[1::2], strict=True)) + list(zip(RULES[::2], RULES[1::2], strict=True)))
def test_english(word, stem):
    assert english_stem(word) == stem


def test_odd_words():
    assert [english_stem(w) for w in ("", "y", "'", "''s", "s's", "123", "ß", "yyyy", "e" * 500)][:2] == ["", "y"]


def test_stored_form(spark):
    rows = [(1, "[reserved text]", "en"), (2, "Laws' relating Parties", "en"), (3, "Laws relating", "fr"), (4, None, "en"), (5, "relating", None), (6, "", "en")]
    df = spark.createDataFrame(rows, "k int, t string, lang string")
    got = {r["k"]: r["f"] for r in df.select("k", search.stored_form(F.col("t"), F.col("lang")).alias("f")).collect()}
    assert got == {1: "", 2: "law relat parti", 3: "laws relating", 4: "", 5: "relating", 6: ""}


def test_lexicon_stems(spark):
    want = Counter(w for _, t, lang in documents("doc_id, text, lang") for w in set(tokenise(t, lang, ALL_STEMMERS)) if len(w.encode()) <= 128)
    assert {r["term"]: r["ndoc"] for r in registry.lexicon_stems(spark, FOLDER).collect()} == want
