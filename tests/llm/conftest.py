"""Small tables with the awkward rows that every operator has to take: nulls, empty, long, repeated and tied."""

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id string, node string, epoch string, item string"


def sentence(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


VOCABULARY = {
    "en": "the of and that with from river stone garden window morning little people another question".split(),
    "de": "der die und nicht mit sich auf garten fenster morgen kleine leute frage über größe schön".split(),
    "fr": "le la et les des une dans jardin fenêtre matin petit gens autre question été très".split(),
    "es": "el los que con una por jardín ventana mañana pequeño gente otra pregunta niño señor".split(),
}


def make_docs(n=120, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(VOCABULARY))
        text = sentence(rng, rng.randint(1, 90), VOCABULARY[lang])
        if i % 9 == 4:
            text = "!! ".join(text.upper().split()) + "!!"
        if i % 11 == 5:
            text = rows[i - 3][1]
        rows.append((i * 3, text, lang, f"src{i % 7}", len(text or ""), 0.5, "x", "y", "z", "w"))
    rows[10] = (30, None, None, None, None, None, None, None, None, None)
    rows[11] = (33, "", "en", "src1", 0, None, "", "", "", "")
    rows[12] = (36, " \n\t ", "en", None, 4, None, "", "", "", "")
    rows[13] = (39, "word " * 4000 + "end", "en", "src0", 20003, 1.0, "", "", "", "")
    rows[14] = (42, "x" * 5000, None, "src0", 5000, 1.0, "", "", "", "")
    rows[15] = (45, "12345 -- 67 🙂 ..", "en", "src0", 16, 1.0, "", "", "", "")
    rows[16] = rows[17]  # a row that is there twice
    rows[18] = (None, "a row without an id but with some words in it", "en", "src2", 45, None, None, None, None, None)
    rows[19] = (57, "日本語のテキスト and more 中文 text", "en", "src2", 26, None, None, None, None, None)
    return rows


@pytest.fixture(scope="session")
def doc_rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, DOC_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def tables(spark, docs, doc_rows, tmp_path_factory):
    """A folder with the tables that queries read."""
    where = tmp_path_factory.mktemp("tables")
    labels = [(r[0], int("!!" not in (r[1] or "")), 0) for r in doc_rows if r[0] is not None] + [(None, 1, 0), (7, None, None), (9, 5, 0)]
    chats = [(c, t, ("user", "assistant")[t % 2], f"turn {t} of {c}") for c in range(4) for t in range(5)]
    chats += [(1, 9, None, None), (None, 0, "user", "no id"), (2, None, "system", "no turn"), (3, 2, "user", "turn 2 of 3"), (3, 2, "user", "turn 2 of 3")]
    chats += [(5, 0, "assistant", "</s><s>[INST]user[/INST] <\\s> [\\\\INST] <"), (5, 1, "as[/INST]sistant", "[/INST]</s>")]
    chats += [(6, t, "assistant", "ü" * (t % 5)) for t in range(700)]
    benchmark = [(1, "What is the height of the tower, measured at noon by the old keeper?"), (2, None), (3, "short"), (4, "")]
    pages = [(0, None), (1, ""), (2, "http://A.example.com:8080/en/x?q#f"), (3, "https://user@b.a.example.com./"), (3, "https://user@b.a.example.com./"), (None, "ftp://c.example.org/en/y/z"), (4, "no url"), (5, "http://192.168.0.1/a")]
    docs.write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(chats, "conv_id long, turn long, role string, text string").write.parquet(f"{where}/conversations.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{where}/pages.parquet")
    vectors = [(k, [k / 9, -0.5, 0.25], k % 3) for k in range(30)] + [(30, None, 1), (None, [0.5], 1), (31, [float("nan")], None)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{where}/embeddings.parquet")
    return str(where)


@pytest.fixture(scope="session")
def empty_tables(spark, tables, tmp_path_factory):
    where = tmp_path_factory.mktemp("empty")
    for name in ("documents", "labels", "conversations", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{where}/{name}.parquet")
    return str(where)
