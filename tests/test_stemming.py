import pyarrow as pa
import pytest

from pressmill.operators import stemming
from pressmill.operators.stemming import porter_stem, stem_tokens

# Word pairs printed in the 1980 paper.
PAPER = """
caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster
bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop
tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky
relational relat conditional condit rational ration valenci valenc hesitanci hesit digitizer digit
conformabli conform radicalli radic differentli differ vileli vile analogousli analog
vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis
hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl
triplicate triplic formative form formalize formal electriciti electr electrical electr
hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin
gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac
adjustment adjust dependent depend adoption adopt homologou homolog communism commun
activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler
probate probat rate rate cease ceas controll control roll roll
""".split()

EXTENDED = {
    "dies": "die", "died": "die", "spied": "spi", "enjoy": "enjoy", "say": "say", "by": "by",
    "fly": "fli", "using": "use", "skies": "sky", "news": "news", "dying": "die",
    "proceed": "proceed", "apology": "apolog", "archaeology": "archaeolog",
    "radically": "radic", "hopefully": "hope", "as": "as", "is": "is",
    "subscribe": "subscrib", "stories": "stori", "picture": "pictur", "gallery": "galleri",
}


@pytest.mark.parametrize("word, stem", zip(PAPER[::2], PAPER[1::2]))
def test_paper(word, stem):
    assert porter_stem(word, extended=False) == stem


@pytest.mark.parametrize("word, stem", EXTENDED.items())
def test_extended(word, stem):
    assert porter_stem(word) == stem


def test_tokens_keep_order_and_length(spark):
    rows = spark.createDataFrame([(1, ["stories", "of", "stories"]), (2, []), (3, None)],
                                 "id int, tokens array<string>")
    got = {r["id"]: r["stems"] for r in stem_tokens(rows, "tokens").collect()}
    assert got == {1: ["stori", "of", "stori"], 2: [], 3: None}


def test_texts_of_a_batch_are_strings_some_at_a_time(spark):
    long = pa.array([None, "ponies cats"] + ["running " * 50_000] * 40)
    parts = list(stemming._parts(long))
    assert max(part.nbytes for part in parts) <= 2 * stemming._PART_BYTES and pa.concat_arrays(parts).equals(long)
    rows = spark.createDataFrame([(i, "ponies " * 20_000 + str(i) if i else None) for i in range(30)], "id int, t string")
    found = dict(rows.repartition(1).select("id", stemming.stem_text("t")).collect())
    assert found == {i: "poni " * 20_000 + str(i) if i else None for i in range(30)}
