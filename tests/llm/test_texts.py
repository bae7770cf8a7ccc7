import random
import string
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curaspark.llm import mojibake, packing, tokens

PATH = tokens.vocabulary("byte_bpe_50k.tiktoken")
CLASH = ["ids", "n_tokens", "size", "part", "container", "cap", "garbled", "restored", "_n", "s"]


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    e = tokens._encoder(PATH)
    return e, tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=e.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_ids_of_any_text(text):
    import tiktoken

    e = tokens._encoder(PATH)
    ref = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    assert e.encode(text) == ref.encode_ordinary(text)


def test_ids_of_long_pieces(reference):
    e, ref = reference
    rng = random.Random(1)
    for alphabet in ("ACGT", "a", "ab", string.ascii_letters, "─", "é"):
        text = "".join(rng.choice(alphabet) for _ in range(5000))
        assert e.encode(text) == ref.encode_ordinary(text)


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumns({c: F.lit("clash") for c in CLASH})


def test_encoded_table(spark, reference):
    texts = [None, "", " ", "a b", "a b", "<|endoftext|>", "Größe 5 µm\r\n", "x" * 200_000, "\U0001f41e"]
    got = {r.doc_id: r.ids for r in tokens.encoded(docs(spark, texts), "doc_id", "text", PATH).collect()}
    assert got[0] == [] and got[1] == [] and got[3] == got[4]
    assert all(got[i] == reference[1].encode_ordinary(t or "") for i, t in enumerate(texts))
    counts = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs(spark, texts), "doc_id", "text", PATH).collect()}
    assert counts == {i: len(x) for i, x in got.items()}
    import pandas as pd

    assert tokens.decoded(pd.Series([got[6], None]), PATH).tolist() == [texts[6], None]
    assert tokens.encoded(docs(spark, texts).limit(0), "doc_id", "text", PATH).count() == 0
    with pytest.raises(FileNotFoundError):
        tokens.vocabulary("no such file")


def brute_fullest(counts, capacity):
    """The largest sum up to capacity that holds the largest size."""
    first = max(s for s in counts if s <= capacity)
    sums = {first}
    for s, c in counts.items():
        for _ in range(c - (s == first)):
            sums |= {x + s for x in sums if x + s <= capacity}
    return max(sums)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 6), min_size=1, max_size=8))
def test_fullest_is_optimal(counts):
    best = packing.fullest(counts, sorted(counts, reverse=True), 60)
    assert all(k <= counts[s] for s, k in best.items())
    assert sum(s * k for s, k in best.items()) == brute_fullest(counts, 60)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 300), max_size=12))
def test_plan_uses_every_item_once(counts):
    bins, used = Counter(), Counter()
    for s, a, b, k, first in packing.plan(counts, 50):
        assert a == used[s] and (b - a) % k == 0
        used[s] = b
        for i in range((b - a) // k):
            bins[first + i] += s * k
    assert used == Counter(counts) and all(v <= 50 for v in bins.values())
    total = sum(s * c for s, c in counts.items())
    assert set(bins) == set(range(len(bins))) and (len(bins) - 1) * 25 <= total


def test_shares_lose_nothing_and_waste_little(spark):
    """Planned in many tasks: every item once, no container over, nearly as few as planned in one go."""
    rng = random.Random(9)
    counts = {s: rng.randrange(1, 9) for s in rng.sample(range(1, 2000), 700)}
    df = spark.createDataFrame([("a", s, c) for s, c in counts.items()] + [("b", 3, 5)], "pack_name string, s int, c bigint")
    got = packing.planned(df, {"a": 2000, "b": 10, "c": 7}, share=60)
    assert set(got) == {"a", "b", "c"} and got["c"] == []
    bins, used = Counter(), Counter()
    for s, a, b, k, first in got["a"]:
        assert a == used[s]
        used[s] = b
        for i in range((b - a) // k):
            bins[first + i] += s * k
    assert used == Counter(counts) and max(bins.values()) <= 2000 and set(bins) == set(range(len(bins)))
    once = packing.plan(dict(counts), 2000)
    assert len(bins) <= 1.02 * len({first + i for _, a, b, k, first in once for i in range((b - a) // k)}) + 1


def packed(spark, sizes, caps, **kw):
    items = spark.createDataFrame(list(enumerate(sizes)), "id bigint, n int").withColumns({c: F.lit("clash") for c in CLASH if c != "n"})
    packs = spark.createDataFrame(caps, "pack_name string, capacity_tokens int")
    return packing.packed(items, "id", "n", packs).collect()


def test_packed_table(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 40)
    rng = random.Random(3)
    sizes = [None, 0, 100, 101, 350, 1] + [7] * 200 + [rng.randrange(1, 130) for _ in range(200)]
    out = packed(spark, sizes, [("a", 100), ("a", 90), ("b", 64), (None, 5), ("c", 0), ("d", None)])
    for name, cap in (("a", 100), ("b", 64)):
        rows = [r for r in out if r.pack_name == name]
        bins = Counter()
        per = Counter()
        for r in rows:
            per[r.id] += r.size
            if r.container is None:
                assert r.size == 0
            else:
                bins[r.container] += r.size
        assert {i: n or 0 for i, n in enumerate(sizes)} == dict(per) and max(bins.values()) <= cap
        parts = Counter(r.id for r in rows)
        assert all(parts[i] == max(1, -(-(n or 0) // cap)) for i, n in enumerate(sizes))
        assert sorted(bins) == list(range(len(bins)))
        assert len(bins) <= 1.03 * sum(n or 0 for n in sizes) / cap + 1
    assert {r.pack_name for r in out} == {"a", "b"}


def test_packed_odd_tables(spark):
    assert packed(spark, [], [("a", 10)]) == [] and packed(spark, [3, 4], []) == []
    assert [(r.size, r.container) for r in packed(spark, [None, 0], [("a", 10)])] == [(0, None)] * 2
    many = packed(spark, [3, 4, 5], [(f"p{i}", 7) for i in range(40)])
    assert len(many) == 120 and all(len({r.container for r in many if r.pack_name == f"p{i}"}) == 2 for i in range(40))
    with pytest.raises(ValueError):
        packed(spark, [1], [("a", packing.MAX_CAPACITY + 1)])


# --- wrong encodings

LANGS = {
    "de": "Die Größe schwankt stark; für ältere Stücke fehlen Maße. Häufig in der Nähe von Bächen, selten auf trockenen Hängen. Prüfung: ungültiger Eintrag, bitte löschen.",
    "fr": "Le mâle diffère de la femelle par ses antennes plus épaisses et sa tête noirâtre. « Étiquette illisible », écrit-il, « peut-être Côte d’Azur ».",
    "pl": "Płytkę przechowywać w łaźni; użyć roztworu. Samica większa od samca, głowa żółta, odnóża ciemne aż do stóp. Należy sprawdzić źródło.",
    "cs": "Štítek je nečitelný; podle sběratele jde o místo Říčany. Samice je větší než samec, hlava žlutá, nohy tmavší, křídla hnědá.",
    "ru": "Самка крупнее самца, голова жёлтая, ноги тёмные. Образец исключён: слишком много неоднозначных оснований. Хранить при низкой температуре.",
    "ja": "雌は雄より大きく、頭部は黄色、脚は暗褐色である。標本は青根山で採集された。ラベルは判読できない。",
    "en": "Signs used below: √ present, ∞ not counted, ≤ 9 specimens at 5 °C ± 2, 3 µl × 4 — see “notes”, price £3 or €4; drawn as ╠══ sister ╚══ rest.",
}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    out = []
    for i in range(700):
        text = LANGS[rng.choice(list(LANGS))]
        parts = text.split(" ")
        at = rng.randrange(max(1, len(parts) - 6))
        out.append(" ".join(parts[at:] + ["No.", str(i)]))
    return out


@pytest.fixture(scope="module")
def restorer(spark, corpus):
    return mojibake.fit(docs(spark, corpus + [None, ""]), "text")


CHAINS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1250"), ("utf-8", "cp1251"), ("utf-8", "mac-roman"), ("utf-8", "cp437"), ("utf-8", "cp850"), ("cp1250", "cp1252"), ("cp1251", "cp1252"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp1252", "mac-roman"), ("cp1252", "cp437"), ("euc-jp", "latin-1")]


def garble(text, written, read):
    try:
        return text.encode(written).decode(read)
    except UnicodeError:
        return None


def test_clean_texts_are_left_alone(restorer, corpus):
    assert [t for t in corpus if restorer.restore(t)[0]] == []


@pytest.mark.parametrize(("written", "read"), CHAINS)
def test_garbled_texts_are_found_and_restored(restorer, written, read):
    tried = 0
    for lang, text in LANGS.items():
        bad = garble(text, written, read)
        if bad is None or bad == text or (lang == "en" and written != "utf-8"):
            continue
        tried += 1
        found, back = restorer.restore(bad)
        assert found, (lang, bad)
        if written == "utf-8" or lang in ("ru", "ja"):
            assert back == text
    assert tried


def test_part_double_and_lost(restorer):
    text = LANGS["de"]
    half = text[:80] + garble(text[80:], "utf-8", "cp1252")
    assert restorer.restore(half) == (True, text)
    twice = garble(garble(LANGS["fr"], "utf-8", "latin-1"), "utf-8", "latin-1")
    assert restorer.restore(twice) == (True, LANGS["fr"])
    lost = text.encode("cp1252").decode("utf-8", "replace")
    assert restorer.restore(lost)[0]
    assert restorer.restore("l&Atilde;&para;schen und gek&Atilde;&frac14;rzt, G&Atilde;&frac14;te")[0]


def test_restored_table(spark, restorer):
    texts = [None, "", "plain ASCII &amp; sa t&ecirc;te noir&acirc;tre", LANGS["ru"], garble(LANGS["ru"], "utf-8", "latin-1"), LANGS["de"] * 300, garble(LANGS["de"] * 300, "utf-8", "cp1252")]
    df = docs(spark, texts + texts)
    got = {r.doc_id: (r.garbled, r.restored) for r in mojibake.restored(df, "doc_id", "text", restorer).collect()}
    n = len(texts)
    for i in range(2 * n):
        want = {4: LANGS["ru"], 6: LANGS["de"] * 300}.get(i % n)
        assert got[i] == ((True, want) if want else (False, None))
    assert mojibake.restored(df.limit(0), "doc_id", "text", restorer).count() == 0


def test_fit_on_an_empty_table(spark):
    r = mojibake.fit(docs(spark, []), "text")
    assert r.restore("abc") == (False, None) and r.restore("�")[0]


def test_every_span_of_a_long_text_is_restored(restorer):
    """However many garbled stretches there are, none is left over."""
    words = LANGS["de"].split(" ")[:9]
    good = " ".join(words)
    bad = garble(good, "utf-8", "cp1252")
    text = " ".join(f"{bad} plain words between the parts, {good} no. {i};" for i in range(250))
    assert restorer.restore(text) == (True, text.replace(bad, good))


def test_margin_has_the_fewest_errors():
    clean, garbled = {0: 9000, 3: 50, 8: 5}, {12: 3, 20: 40, 60: 900, mojibake.TOP: 5000}
    margin, above, below = mojibake.best_margin(clean, garbled, 1000)
    assert 4.0 <= margin < 10.0 and above == 0 and below <= 3 / 5943
    # a tenth of garbled texts among the clean ones neither cuts anything off nor moves the margin
    assert mojibake.best_margin(clean | {mojibake.TOP: 900}, garbled, 1000)[0] == margin
    assert mojibake.best_margin({}, {}, 0)[0] > 4


def test_planted_parts_can_be_undone():
    for text in LANGS.values():
        bad = mojibake.planted(text)
        assert bad is not None and bad != text
    assert mojibake.planted("ascii") is None


def test_every_clean_text_is_planted(spark):
    """The margin's missed cases are counted on a copy of each clean text, not of some."""
    texts = [f"{t} {i}" for t in LANGS.values() for i in range(8)]
    clean = [t for t in texts if not t.isascii() and not mojibake._marked(t)]
    model = mojibake.CharModel.of(mojibake._count_grams(texts))
    got = mojibake._judged(spark.createDataFrame([(t,) for t in texts], "s string"), "s", [mojibake.Restorer(model, 0.0)] * 2).filter("kind = -2").agg(F.sum("n")).first()[0]
    assert got == sum(mojibake.planted(t) is not None for t in clean) > 0


def test_fit_holds_texts_out(restorer):
    false, missed = restorer.rates
    assert false <= 0.01 and missed <= 0.2


def test_lost_signs_are_judged_by_the_model(restorer):
    """A lost letter in a word is far likelier than a sign that the writer meant; what the model has seen meant is no case."""
    assert restorer.lost("ein gr�ßer Ort") > restorer.margin
    meant = mojibake.Restorer(mojibake.CharModel.of(mojibake._count_grams(["the sign � on it, the sign � on it"] * 2000)), restorer.margin)
    assert meant.restore("the sign � on it") == (False, None)


def test_lost_blanks_are_no_reading(restorer):
    assert restorer.restore("5\xa0km from here") == (False, None)


@pytest.mark.parametrize("read", ["latin-1", "mac-roman", "cp437", "cp850"])
def test_garbled_beside_clean_japanese(restorer, read):
    a, b, c = LANGS["ja"].split("。")[:3]
    bad = garble(b, "utf-8", read)
    for left, right in ((a, c), (a, ""), ("", c)):
        assert restorer.restore(left + "。" + bad + "。" + right) == (True, left + "。" + b + "。" + right)
        assert restorer.restore(left + "。" + b + "。" + right) == (False, None)
    assert restorer.restore(f"{a}。{bad}。{c}。{bad}。{a}") == (True, f"{a}。{b}。{c}。{b}。{a}")
    assert mojibake.looks_reread(a + bad + c) and not mojibake.looks_reread(a + b + c)


def test_garbled_glued_to_another_script(restorer):
    assert restorer.restore(f"Самка/{garble('größer', 'utf-8', 'cp1252')}/самца") == (True, "Самка/größer/самца")
