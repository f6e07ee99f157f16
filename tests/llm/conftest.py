import pytest

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))

# doc_id, text, lang, source, n_chars, and columns that clash with names used inside.
AWKWARD = [
    (1, "One plain text about the weather in the north and the south.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "en", ""),
    (5, "word", "en", "a"),
    (6, "word", "en", "a"),
    (7, LONG, "en", "b"),
    (8, LONG + " tail", "en", "b"),
    (9, "1234 5678 --- !!!", "fr", "b"),
    (10, "x\x00y été \U0001f600 中文 <|endoftext|>", "fr", None),
    (11, "Le texte de la ville et les enfants dans la rue. " + PASSAGE, "fr", "c"),
    (11, "Le texte de la ville et les enfants dans la rue. " + PASSAGE, "fr", "c"),
    (12, PASSAGE + " a tail of its own", "en", "c"),
    (None, "a row without an id and the usual words of the language", "en", "a"),
    (None, None, None, None),
    (13, "a" * 700, "en", "z"),
    (14, "Released under the MIT License. CC BY-NC 4.0, GNU General Public License", "en", "z"),
]
CLASHING = "_row string, _id string, _key string, node long, size string, place int, at int, run int"


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), "r", "i", "k", 5, "s", 1, 2, 3) for r in AWKWARD]
    frame = spark.createDataFrame(
        rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    ).repartition(3).cache()
    yield frame
    frame.unpersist(True)


@pytest.fixture(scope="session")
def no_documents(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, PASSAGE, 0), (1, PASSAGE, 0), (2, "too short", 0), (3, None, 0), (4, "", 0),
         (None, "one plain text about the weather", 0)],
        "item_id long, text string, seed int",
    )


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    names = ("documents", "labels", "benchmark", "embeddings")
    frames = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet").cache() for n in names}
    yield frames
    for frame in frames.values():
        frame.unpersist(True)
