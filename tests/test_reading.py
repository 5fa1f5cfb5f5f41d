"""Delimited reading against a plain reader on the same bytes."""

import io
import random

import pandas as pd
import pytest
from pyspark.sql import types as T

from rawlane.functions.text import NULL_TOKENS
from rawlane.sources.delimited import read_delimited, with_record_numbers
from rawlane.sources.manifest import ASSEMBLED, LINES, build_manifest, route_files
from rawlane.specs import BASE_OFICIAL, DatasetSpec

SPEC = DatasetSpec(
    "dados",
    "dados",
    "dados",
    T.StructType([T.StructField(c, T.StringType()) for c in "abc"]),
    (),
    header=("a", "b", "c"),
)


def plain(content: bytes) -> list[tuple]:
    """The same file read front to back in one piece."""
    try:
        text = content.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = content.decode("latin-1")
    first = text.split("\n", 1)[0]
    sep = next((s for s in ";,\t" if s in first), ",")
    frame = pd.read_csv(io.StringIO(text), sep=sep, dtype=str, on_bad_lines="skip")
    frame = frame.astype(object).where(frame.notna(), None)
    return [(*row, i + 2) for i, row in enumerate(frame.itertuples(index=False, name=None))]


def by_characters(content: bytes, sep: str = ";") -> list[tuple]:
    """The same, one character after another; the library can fail on files with lone carriage returns."""
    text, rows, row, cell = content.decode(), [], [], ""
    state, i = "start", 0  # of a cell; or plain, quoted, closed

    def close_row() -> None:
        nonlocal row, cell
        if row or cell.strip(" \t") or state in ("quoted", "closed"):
            rows.append([*row, cell])
        row, cell = [], ""

    while i < len(text):
        c = text[i]
        if state == "quoted" and c != '"':
            cell += c
        elif c == '"' and state in ("start", "quoted", "closed"):
            cell += '"' if state == "closed" else ""
            state = "closed" if state == "quoted" else "quoted"
        elif c == sep:
            row, cell, state = [*row, cell], "", "start"
        elif c in "\r\n":
            close_row()
            state = "start"
            i += text[i : i + 2] == "\r\n"
        else:
            cell, state = cell + c, "plain"
        i += 1
    if state != "start" or row:
        close_row()
    width = len(rows[0])
    kept = [[*r, *[None] * (width - len(r))] for r in rows[1:] if len(r) <= width]
    return [(*(None if x in NULL_TOKENS else x for x in r), i + 2) for i, r in enumerate(kept)]


def read(spark, folder, limit, spec=SPEC):
    manifest = route_files(build_manifest(spark, str(folder), limit), [spec])
    layouts = {r.file_name: r.layout for r in manifest.collect()}
    names = spec.target.fieldNames()
    rows = with_record_numbers(read_delimited(spark, manifest, spec)).select("source_filename", *names, "numero_linha")
    got = {}
    for row in rows.collect():
        got.setdefault(row[0], []).append(tuple(row[1:]))
    return {k: sorted(v, key=lambda r: r[-1]) for k, v in got.items()}, layouts


FILES = {
    "dados_virgula.csv": b"a,b,c\n1,2,3\n4,5,6\n",
    "dados_ponto.csv": b"a;b;c\r\n1;2,5;3\r\n4;5;6\r\n",
    "dados_tab.csv": b"a\tb\tc\n1\t2\t3\n\t\t\n   \n4\t5\t6\n",
    "dados_latin.csv": "a;b;c\nção;é;ü\n".encode("latin-1"),
    "dados_utf8.csv": "a;b;c\nção;é;ü\n".encode(),
    "dados_bom.csv": "﻿a;b;c\n1;2;3\n".encode(),
    "dados_irregular.csv": b'a;b;c\n1;2\n\n1;2;3;4\n5;6;7;\n"x;y";2;3\n"q\nz";5;6\n   \n8;9;10',
    "dados_aspas.csv": b'a;b;c\n5" tubo;2;3\n"diz ""oi""";4;"";\n"";"a""\n""b";c\nx;"y";z\n',
    "dados_tokens.csv": b"a;b;c\nNA;null;NaN\nN/A;  ;None\n#N/A;<NA>;x\n",
    "dados espaco+1 [x].csv": b"a;b;c\n1;2;3\n",
    "dados_vazio.csv": b"a;b;c\n",
    "dados_cr.csv": b"a;b;c\r1;2;3\r\r4;5\r6;7;8;9\r10;11;12\r",
    "dados_fins.csv": b"a;b;c\r\n1;2;3\r4;5;6\n\n7;8;9\r\r\n10;11;12",
    "dados_cr_aspas.csv": b'a;b;c\r"x\ry";2;3\r4;"p\r\nq";6\r7;"u\nv";""\r',
    "dados_crlf_aspas.csv": b'a;b;c\r\n"x\r\ny";2;3\r\n"\r\n";"\r";"\n"\r\n4;5;6\r\n',
    "dados_caudas.csv": b'a;b;c\n"x"y;2;3\n"";""z;"a""b"c"d\n"p\nq"r;"s"";t";"u" \n"v"w"x;y"z;1\n',
    "dados_caudas_tab.csv": b'a\tb\tc\n"x"y\t2\t3\n4\t"a\tb" c\t6\n',
}


@pytest.fixture
def folder(tmp_path):
    for name, content in FILES.items():
        (tmp_path / name).write_bytes(content)
    return tmp_path


@pytest.mark.parametrize("limit", [10**6, 0], ids=["whole files", "split lines"])
def test_fixture_files(spark, folder, settings, limit):
    with settings(spark__sql__files__maxPartitionBytes="12", spark__sql__files__openCostInBytes="0"):
        got, layouts = read(spark, folder, limit)
    for name, content in FILES.items():
        assert got.get(name, []) == plain(content), name
    for name in ("dados_irregular.csv", "dados_tab.csv", "dados_cr_aspas.csv", "dados_caudas.csv"):
        assert layouts[name] == ASSEMBLED
    for name in ("dados_virgula.csv", "dados_cr.csv", "dados_fins.csv"):
        assert layouts[name] == LINES


def random_file(rng: random.Random) -> bytes:
    def cell():
        kind = rng.random()
        if kind < 0.15:
            inner = "".join(rng.choice(['""', "\n", ";", "t", "é", '""""', " ", "\r\n", "\r"]) for _ in range(rng.randint(0, 6)))
            return f'"{inner}"' + (rng.choice(["", "", "", "z", 'y"', " "]))
        if kind < 0.25:
            return f'{rng.randint(1, 9)}" tubo'
        return rng.choice(["", "x", "longer text", "NA", " y "])

    # The plain reader takes a first row that is too long for row labels; here such a row is dropped like any other.
    counts = [3] + [rng.choice([2, 3, 3, 3, 3, 4]) for _ in range(rng.randint(5, 40))]
    lines = [";".join(cell() for _ in range(count)) for count in counts]
    lines = [line if line.strip() else "z" for line in lines]
    ends = rng.choice([["\n"], ["\r\n"], ["\r"], ["\n", "\r\n", "\r"]])
    return ("a;b;c\n" + "".join(line + rng.choice(ends) for line in lines)).encode()


def test_random_files_in_small_splits(spark, tmp_path, settings):
    contents = {f"dados_{i}.csv": random_file(random.Random(i)) for i in range(40)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    with settings(spark__sql__files__maxPartitionBytes="64", spark__sql__files__openCostInBytes="0"):
        got, layouts = read(spark, tmp_path, 0)
    assert ASSEMBLED in layouts.values()
    for name, content in contents.items():
        assert got.get(name, []) == by_characters(content), name
        if b"\r" not in content:
            assert by_characters(content) == plain(content), name


def test_facts_do_not_depend_on_how_files_are_read(spark, folder, settings):
    """Fingerprints and all else of a file are the same read whole or in splits of any size."""
    (folder / "dados_sem_fim.csv").write_bytes(FILES["dados_virgula.csv"][:-1])
    (folder / "dados_copia.csv").write_bytes(FILES["dados_cr_aspas.csv"])
    (folder / "dados_brancos.csv").write_bytes(b"\n\n  \na;b;c\n1;2;3\n")
    (folder / "dados_trocado.csv").write_bytes(b"a,b,c\n4,5,6\n1,2,3\n")
    seen = []
    for limit, size in ((10**6, "100000"), (0, "100000"), (0, "33"), (0, "7"), (30, "12")):
        with settings(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="0"):
            rows = build_manifest(spark, str(folder), limit).collect()
        seen.append({r.file_name: tuple(r[c] for c in ("length", "file_hash", "encoding", "sep", "header", "layout", "unclosed")) for r in rows})
    for name in seen[0]:
        assert len({str(facts[name]) for facts in seen}) == 1, (name, [facts[name] for facts in seen])
    hashes = {name: facts[1] for name, facts in seen[0].items()}
    assert hashes["dados_copia.csv"] == hashes["dados_cr_aspas.csv"]
    assert len(set(hashes.values())) == len(hashes) - 1


def test_fingerprint_of_large_files_does_not_depend_on_splits(spark, tmp_path, settings):
    content = "a;b;c\n" + "".join(f"{i};x;y\n" for i in range(300))
    swapped = content.replace("7;x;y\n8;x;y\n", "8;x;y\n7;x;y\n", 1)
    for name, text in {"dados_1.csv": content, "dados_2.csv": content, "dados_3.csv": swapped}.items():
        (tmp_path / name).write_text(text)
    hashes = []
    for size in ("50", "777", "100000"):
        with settings(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="0"):
            rows = build_manifest(spark, str(tmp_path), 0).collect()
        hashes.append({r.file_name: r.file_hash for r in rows})
    assert hashes[0] == hashes[1] == hashes[2]
    assert hashes[0]["dados_1.csv"] == hashes[0]["dados_2.csv"] != hashes[0]["dados_3.csv"]


def test_columns_by_name_without_a_template(spark, tmp_path):
    (tmp_path / "base_oficial_1.csv").write_text("obs,cnpj,extra,cnpj\nalgo,1,e,9\n,2,,\n")
    (tmp_path / "base_oficial_2.csv").write_text('"cnpj",grupo\n3,g\n')
    got, _ = read(spark, tmp_path, 10**6, BASE_OFICIAL)
    names = BASE_OFICIAL.target.fieldNames()
    at = {n: i for i, n in enumerate(names)}
    first, second = got["base_oficial_1.csv"], got["base_oficial_2.csv"][0]
    assert [(r[at["cnpj"]], r[at["obs"]], r[at["grupo"]]) for r in first] == [("1", "algo", None), ("2", None, None)]
    assert (second[at["cnpj"]], second[at["grupo"]], second[at["obs"]]) == ("3", "g", None)


def test_line_sums_are_compiled(spark):
    """What a line adds to a fingerprint is no function over an array, which Spark does not compile."""
    from pyspark.sql import functions as F

    from rawlane.sources.digest import line_shares

    plan = spark.range(3).select(line_shares(F.col("id").cast("string"), F.col("id")).alias("x"))._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "*(1)" in plan


def test_whole_files_are_summed_without_powers(spark):
    """Each line looked the powers of the base up, four times, in code that is not compiled."""
    from rawlane.sources.digest import BASE, PRIME
    from rawlane.sources.manifest import describe_content

    files = spark.createDataFrame([(bytearray(b"a;b\n1;2\n"),)], "content binary")
    plan = describe_content(files)._jdf.queryExecution().optimizedPlan().toString()
    assert str(BASE) in plan and str(BASE**2 % PRIME) not in plan


def test_files_without_odd_quotes_need_no_look_at_lines(spark):
    """One scan of a text tells that no line hides records; it never says so of a text where one does."""
    from pyspark.sql import functions as F

    from rawlane.sources.manifest import SEPARATORS
    from rawlane.sources.quoting import ends_in_quotes, hides_records, odd_quotes

    rng = random.Random(3)
    parts = ['"', '""', ";", ",", "\t", "\n", "\r", "\r\n", "a", "$", '"a"', ';"b"', ';"";', '\n"x"', "﻿"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    plain = 'a;b\r\n"x";"1,5"\r\n"";"y z"\r\n' * 50
    df = spark.createDataFrame([(t,) for t in [*texts, plain]], "text string")
    for sep in SEPARATORS:
        lines = F.split("text", "\n")
        odd = odd_quotes(F.col("text"), sep).alias("odd")
        hides = F.exists(lines, lambda line: hides_records(line, sep)) | ends_in_quotes(F.col("text"), F.lit(sep))
        rows = df.select("text", odd, hides.alias("hides")).collect()
        assert not [r.text for r in rows if r.hides and not r.odd]
        assert any(not r.odd and '"' in r.text for r in rows) and any(r.hides for r in rows)
    assert not df.where(F.col("text") == plain).select(odd_quotes(F.col("text"), ";")).first()[0]
