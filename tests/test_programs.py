"""The three end-to-end programs on small input files."""

import random

from quire.plans import programs


def test_rank_articles(spark, tmp_path, capsys):
    p = tmp_path / "articles.dat"
    texts = ["Scala and Java", "Java only", "Python, not Python", "Scala is fun", "Java Java"]
    p.write_text("".join(f"X<page><title>t{i}</title><text>{t}</text></page>YY\n" for i, t in enumerate(texts)))
    out = programs.rank_articles(spark, str(p))
    assert out["naive"] == out["index"] == out["by_key"]
    assert out["naive"][:2] == [("Java", 3), ("Scala", 2)]
    assert dict(out["naive"])["Python"] == 1  # "Python," is not a mention
    assert "ranking by term counts: " in out["timing"]


def test_cluster_postings(spark, tmp_path, capsys):
    rnd = random.Random(3)
    lines, qid = [], 1
    for tag in programs.LANGUAGES[:3]:
        for _ in range(30):
            lines.append(f"1,{qid},,,0,{tag}")
            lines += [f"2,{100000 + qid * 10 + a},,{qid},{rnd.randint(0, 40)}," for a in range(2)]
            qid += 1
    p = tmp_path / "postings.csv"
    p.write_text("\n".join(lines) + "\n")
    vocab = programs.LANGUAGES[:3]
    summary = programs.cluster_postings(spark, str(p), vocab=vocab, kernels=6, expected_vectors=90)
    got = summary.collect()
    assert sum(r["size"] for r in got) == 90
    assert {r["label"] for r in got} == set(vocab)
    out = capsys.readouterr().out
    assert "Resulting clusters:" in out and "Iteration: 1" in out


def test_summarise_time_use(spark, tmp_path, capsys):
    p = tmp_path / "survey.csv"
    p.write_text("tucaseid,telfs,tesex,teage,t010101,t050101,t020101\n1,1,1,30,600,480,120\n3,3,2,20,500,0,400\n")
    got = [tuple(r) for r in programs.summarise_time_use(spark, str(p)).collect()]
    assert got == [("not working", "female", "young", 8.3, 0.0, 6.7), ("working", "male", "active", 10.0, 8.0, 2.0)]


def test_survey_types_by_header_or_inferred(spark, tmp_path):
    p = tmp_path / "survey.csv"
    p.write_text("tucaseid,telfs,tesex,teage,t010101,t050101,t020101\n01,1,1,30,600,480,120\n03,3,2,20,500,0,400\n")
    plain, inferred = (sorted(programs.summarise_time_use(spark, str(p), infer).collect()) for infer in (False, True))
    assert plain == inferred and len(plain) == 2


def test_command_line_parameters(spark, tmp_path, monkeypatch):
    from quire import __main__ as cli
    seen = {}
    monkeypatch.setattr(cli.programs, "cluster_postings", lambda s, path, *a, **k: seen.update(args=a, **k))
    monkeypatch.setattr(type(spark), "stop", lambda s: None)
    cli.main(["postings", str(tmp_path), "--vocab", "Java,Scala", "--spread", "700", "--kernels", "4", "--eta", "2.5",
              "--max-iterations", "9", "--expected", "11"])
    assert seen == {"args": (["Java", "Scala"], 700, 4, 2.5, 9), "expected_vectors": 11}


def test_cluster_postings_checks_expected_count(spark, tmp_path):
    import pytest
    p = tmp_path / "postings.csv"
    p.write_text("1,1,,,0,Java\n2,2,,1,5,\n")
    with pytest.raises(Exception, match="unexpected vector count"):
        programs.cluster_postings(spark, str(p), vocab=["Java"], kernels=1, expected_vectors=2, debug=False)
