import pytest

import corpusloom as cl


@pytest.fixture
def model():
    merges = [(104, 101, 256), (32, 256, 257), (195, 169, 258), (257, 258, 259)]
    return cl.TokenizerModel(merges, cl.GPT4PAT, {"<|endoftext|>": 260, "<|pad|>": 300})


def test_tokenizer_files(spark, model, tmp_path):
    path = str(tmp_path / "tok")
    cl.save_tokenizer(spark, model, path)
    for suffix in (".model", ".tables"):
        back = cl.load_tokenizer(spark, path + suffix)
        assert (back.merges, back.pattern, back.special_tokens) == (model.merges, model.pattern, model.special_tokens)
        assert back.vocab() == model.vocab() and back.vocab_size == 260
    lines = [r["value"] for r in spark.read.text(path + ".model").collect()]
    assert lines[:2] == ["version: v1", "pattern:"] and lines[3:5] == ["num_special_tokens: 2", "<|endoftext|> 260"]
    assert lines[6] == "(104, 101)->256"
    report = [r["value"] for r in spark.read.text(path + ".vocab").collect()]
    assert report[10] == "[\\u000a] 10" and report[65] == "[A] 65" and report[200] == "[�] 200"
    assert report[257] == "[ ][he] -> [ he] 257"
    with pytest.raises(ValueError):
        cl.load_tokenizer(spark, path)


def test_plain_file_and_whole_text_model(spark, tmp_path):
    (tmp_path / "x.model").write_text("version: v1\npattern:\nNone\nnum_special_tokens: 0\n(97, 97)->256\n")
    model = cl.load_tokenizer(spark, str(tmp_path / "x.model"))
    assert (model.merges, model.pattern, model.special_tokens) == ([(97, 97, 256)], None, {})


def test_text_format_refuses_what_it_cannot_hold(spark, tmp_path):
    spaced = cl.TokenizerModel([], special_tokens={"a b": 256})
    with pytest.raises(ValueError):
        cl.save_tokenizer(spark, spaced, str(tmp_path / "s"))


def test_vocab_views(spark, model):
    pretty = [r["merge"] for r in cl.merges_pretty(spark, model).collect()]
    assert pretty == ["[h][e] -> [he]", "[ ][he] -> [ he]", "[�][�] -> [é]", "[ he][é] -> [ heé]"]
    assert model.merges_table(spark).count() == 4
    assert model.vocab_table(spark).count() == model.vocab_size


def test_corpus_selection(spark, tmp_path):
    rows = {"en": ["e1", "e2"], "zh": ["z1", "z2"]}
    for lang, values in rows.items():
        for part, value in enumerate(values):
            df = spark.createDataFrame([(value, lang)], "text string, lang string").coalesce(1)
            df.write.parquet(str(tmp_path / "data" / "20230901" / lang / f"train-{part}.parquet"))
    base = str(tmp_path)
    whole = cl.read_corpus(spark, base, dump="20230901", lang=["en", "zh"], files=["train-0.parquet", "train-1.parquet"])
    assert {r["text"] for r in whole.collect()} == {"e1", "e2", "z1", "z2"}
    one = cl.read_corpus(spark, base, ["train-1.parquet"], "zh", "20230901", ["text"], "text STRING, lang STRING")
    assert [tuple(r) for r in one.collect()] == [("z2",)]
    with pytest.raises(ValueError):
        cl.read_corpus(spark, base, [], "zh", "20230901")
    with pytest.raises(ValueError):
        cl.read_corpus(spark, base, dump="20230901")


def test_corpus_order(spark, tmp_path):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "c"))
    found = cl.with_corpus_order(cl.read_corpus(spark, str(tmp_path / "c"))).collect()
    assert sorted(r["doc_ord"] for r in found) == list(range(100))


def test_a_file_list_for_each_language(spark, tmp_path):
    for lang, name in (("en", "a"), ("en", "b"), ("zh", "a"), ("fr", "a")):
        spark.createDataFrame([(lang + name,)], "text string").write.parquet(f"{tmp_path}/data/d.1/{lang}/{name}.parquet")
    lists = {"en": ["b.parquet"], "zh": ["a.parquet"]}
    found = cl.read_corpus(spark, str(tmp_path), lists, dump="d.1").collect()
    assert sorted((r["lang"], r["text"]) for r in found) == [("en", "enb"), ("zh", "zha")]
    one = cl.read_corpus(spark, str(tmp_path), lists, lang="zh", dump="d.1", columns=["text"]).collect()
    assert [tuple(r) for r in one] == [("zha",)]
    for bad in ({"en": []}, {}):
        with pytest.raises(ValueError):
            cl.read_corpus(spark, str(tmp_path), bad, lang="en", dump="d.1")
    with pytest.raises(ValueError):
        cl.read_corpus(spark, str(tmp_path), lists)
