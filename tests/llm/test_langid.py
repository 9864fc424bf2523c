import random

from pyspark.sql import functions as F

from fareloom.llm import langid
from tests.llm.conftest import PROSE, rows


def plain_phrases(text, reference):
    """Greedy longest matches in the reference, by substring search, stretch by stretch."""
    count = 0
    for start in range(0, len(text), langid.STRETCH):
        part, at = text[start : start + langid.STRETCH], 0
        while at < len(part):
            size = 1
            while at + size <= len(part) and part[at : at + size] in reference:
                size += 1
            at += max(size - 1, 1)
            count += 1
    return count


def test_phrases_equal_a_plain_search():
    drawn = random.Random(2)
    make = lambda letters, n: "".join(drawn.choice(letters) for _ in range(n))
    references = {"a": make("abc ", 400), "b": make("bcd ", 700)}
    model = langid.build_model(references)
    cleaned = [langid.letters(references[lang]) for lang in model.languages]
    texts = [make("abcd ", drawn.randrange(1, 700)) for _ in range(30)] + ["a", "zzz", "abc\nabc"]
    found = langid.phrase_counts(texts, model)
    for row, text in zip(found.tolist(), texts):
        seen = langid.letters(text)
        assert row == [plain_phrases(seen, reference) for reference in cleaned]


def test_every_character_of_a_reference_is_told_apart():
    drawn = random.Random(5)
    scripts = {"zh": range(0x4E00, 0x5200), "ko": range(0xAC00, 0xAE00), "ru": range(0x430, 0x450), "en": range(97, 123)}
    words = {lang: ["".join(map(chr, drawn.choices(script, k=4))) for _ in range(400)] for lang, script in scripts.items()}
    # A language in the same script as another.
    words["ja"] = ["".join(map(chr, drawn.choices(scripts["zh"], k=4))) for _ in range(400)]
    make = lambda lang, n: " ".join(drawn.choices(words[lang], k=n))
    references = {lang: make(lang, 900) for lang in words}
    model = langid.build_model(references)
    texts = [make(lang, 60) for lang in words for _ in range(4)]
    cleaned = [langid.letters(references[lang]) for lang in model.languages]
    assert langid.phrase_counts(texts, model).tolist() == [[plain_phrases(t, r) for r in cleaned] for t in texts]
    found, scores = langid.predict(texts, model)
    assert found == [lang for lang in words for _ in range(4)] and scores.min() > 0.1


def test_languages_of_long_documents_and_many_languages_are_learned(spark):
    drawn = random.Random(9)
    vocabulary = {f"l{n:02}": ["".join(drawn.choices("abcdefghij", k=6)) for _ in range(30)] for n in range(70)}
    long = " ".join(drawn.choices(["".join(drawn.choices("abcdefghij", k=6)) for _ in range(30)], k=1500))
    docs = [(100 * k + i, " ".join(drawn.choices(words, k=40)), lang)
            for k, (lang, words) in enumerate(vocabulary.items()) for i in range(12)]
    docs += [(9000 + i, long + f" {i}", "only long") for i in range(12)]
    assert len(long) > langid.LONGEST_SAMPLE
    frame = rows(spark, docs)
    assert set(langid.references(frame)) == {*vocabulary, "only long"}
    found = {r["doc_id"]: r["lang_pred"] for r in langid.language_id(frame).collect()}
    assert sum(found[i] == lang for i, _, lang in docs) > 0.98 * len(docs)


def test_each_language_gives_a_document_however_small_its_share(spark):
    docs = [(i, PROSE + str(i), "en") for i in range(3000)]
    assert set(langid.references(rows(spark, docs), 1)) == {"en"}


def test_automaton_accepts_exactly_the_substrings():
    text = "abracadabra"
    moves = langid.suffix_automaton(text)

    def accepted(word):
        state = 0
        for char in word:
            if char not in moves[state]:
                return False
            state = moves[state][char]
        return True

    for i in range(len(text)):
        for j in range(i, len(text) + 1):
            assert accepted(text[i:j])
    assert not accepted("abc") and not accepted("raa")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = langid.language_id(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert told.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_odd_rows(spark, odd_documents, no_documents):
    found = langid.language_id(odd_documents).collect()
    assert len(found) == odd_documents.count()
    assert all((r["lang_pred"] == "und") == (r["score"] == 0) or r["lang_pred"] != "und" for r in found)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[6]["lang_pred"] == by_id[5]["lang_pred"] == by_id[10]["lang_pred"] == "und"
    assert by_id[None]["held_out"] and all(0 <= r["score"] <= 1 for r in found)
    assert langid.language_id(no_documents).count() == 0


def test_predictions_never_use_the_language_column(spark):
    told = [(i, PROSE + str(i) * 3, "en") for i in range(40)]
    other = [(i, "der alte steg über den fluss " * 5 + str(i), "de") for i in range(40, 80)]
    docs = rows(spark, told + other)
    model = langid.build_model(langid.references(docs))
    blind = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")), model).collect()
    assert {r["doc_id"]: r["__lang"] for r in blind} == {i: lang for i, _, lang in told + other}


def test_without_languages_all_is_undetermined(spark):
    docs = rows(spark, [(1, "some text", None), (2, "more text", None)])
    assert {r["lang_pred"] for r in langid.language_id(docs).collect()} == {"und"}


def test_filter_keeps_all_columns(odd_documents):
    kept = langid.in_known_language(odd_documents, 0.0)
    assert kept.schema == odd_documents.schema
    assert kept.where("doc_id in (5, 6, 10)").count() == 0
