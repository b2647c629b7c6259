import json

from inkmill import __main__ as cli
from inkmill import config


def test_config(spark, tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# x\nINKMILL_TRANSLATE_MODE='gloss'\nINKMILL_AUDIO_COVER_WIDTH=bad\nINKMILL_TRANSLATE_URL = u\n")
    monkeypatch.setenv("INKMILL_TRANSLATE_URL", "env")
    found = config.load(None, tmp_path / ".env")
    assert (found.translate.mode, found.translate.url, found.audio.cover_width, found.translate.batch_chars) == ("gloss", "env", 1400, 3000)
    spark.conf.set("inkmill.translate.batch_chars", "7")
    assert config.load(spark, tmp_path / "none").translate.batch_chars == 7
    spark.conf.unset("inkmill.translate.batch_chars")
    assert config.resolve("/a") == config.resolve("/a", "/b") and str(config.resolve("c", "/b")) == "/b/c"


def test_commands(spark, tmp_path, capsys):
    md = tmp_path / "x" / "a.md"
    md.parent.mkdir()
    md.write_text("# Một\n\n" + "x " * 50)
    assert cli.main(["extract", str(md), "--license", "cc0"], spark) == 0 and "Một" in capsys.readouterr().out
    assert cli.main(["extract", str(md), "--license", "mine"], spark) == 2
    book = tmp_path / "books" / "a" / "book.json"
    book.parent.mkdir(parents=True)
    book.write_text(json.dumps({"slug": "a", "title": "t", "author": "x", "license": "cc0", "license_url": "u", "rights_note": "n"}))
    assert cli.main(["rights", str(tmp_path / "books")], spark) == 0
    book.write_text(json.dumps({"slug": "a", "license": "mine"}))
    assert cli.main(["rights", str(tmp_path / "books")], spark) == 1 and "a: licence:mine" in capsys.readouterr().out
    wiki = tmp_path / "w" / "a.wiki"
    wiki.parent.mkdir()
    wiki.write_text("a [b](c) class=\"k\"")
    assert cli.main(["leftovers", str(wiki.parent)], spark) == 1 and "[b](c)" in capsys.readouterr().out
    assert cli.main(["attributes", str(wiki.parent)], spark) == 0 and "class=k" in capsys.readouterr().out
    spark.createDataFrame([("a", 1, "T", "p", "# T\n\nx\n", 3)], "slug string, index int, title string, source_path string, markdown string, word_count int").write.parquet(str(tmp_path / "ch"))
    assert cli.main(["check", str(tmp_path / "ch")], spark) == 1 and "total-words" in capsys.readouterr().out


def test_build_and_gate(spark, tmp_path, capsys):
    (tmp_path / "c.json").write_text(json.dumps({"books": [{"slug": "a", "title": "t", "author": "x", "license": "cc0", "license_url": "u", "rights_note": "n"}, {"slug": "b", "license": "mine"}, {"slug": "c", "license": "cc0"}]}))
    for slug in ("a", "b"):
        (tmp_path / "src" / slug).mkdir(parents=True)
        (tmp_path / "src" / slug / "1.txt").write_text("Chương 1\n" + "Một câu văn dài. " * 40 + "\nChương 2\n" + "Câu khác nữa đây. " * 40)
    assert cli.main(["build", str(tmp_path / "c.json"), str(tmp_path / "src"), str(tmp_path / "books"), "--created-at", "now"], spark) == 1
    assert capsys.readouterr().out.split("\n")[:3] == ["a: ok", "b: rights-blocked", "c: offline"]
    assert (tmp_path / "books/a/text/chuong-02.md").exists() and json.loads((tmp_path / "books/a/manifest.json").read_text())["created_at"] == "now" and not (tmp_path / "books/b").exists()
    assert cli.main(["rights", str(tmp_path / "books")], spark) == 0
    for f in (tmp_path / "books/a/text").iterdir():
        f.rename(f.with_suffix(".txt"))
    assert cli.main(["rights", str(tmp_path / "books")], spark) == 1 and "no-text-files" in capsys.readouterr().out
    spark.createDataFrame([("a", 1, "T", "p", "# T\n\nx\n", 3)], "slug string, index int, title string, source_path string, markdown string, word_count int").write.parquet(str(tmp_path / "ch"))
    assert cli.main(["gate", str(tmp_path / "books"), str(tmp_path / "ch")], spark) == 1


def test_wiki_commands(spark, capsys):
    def answer(endpoint, params):
        if params.get("action") == "parse":
            return {"parse": {"wikitext": "== A ==\n" + "x " * 300, "text": ""}}
        if params.get("list"):
            return {"query": {"allpages": []}}
        return {"query": {"pages": [{"missing": True} if params["titles"] == "no" else {"title": "A", "pageid": 1}]}}

    assert cli.main(["probe", "A"], spark, answer) == 0 and '"available": true' in capsys.readouterr().out
    assert cli.main(["probe", "no"], spark, answer) == 1
    assert cli.main(["page", "A"], spark, answer) == 0 and '"wikitext": 608' in capsys.readouterr().out
