"""Whole intakes over small files."""

import datetime as dt
import os
from decimal import Decimal
from pathlib import Path

import pytest

from rawlane import BASE_OFICIAL, FATURAMENTO, USUARIOS
from rawlane.plans import ingest as ingest_module
from rawlane.plans.ingest import ingest
from rawlane.streaming.intake import ingest_stream

GOOD = {
    "numero_documento": "1",
    "cnpj": "11222333000181",
    "data_fat": "05/03/2024",
    "valor_da_conta": " 1.000,50 ",
    "empresa": "Alfa",
    "nome_fantasia": "Loja",
    "categorioa": "K",
}


def billing(*rows, header=FATURAMENTO.header, sep=";"):
    lines = [sep.join(header)]
    lines += [sep.join(f'"{v}"' if sep in v else v for v in ({**GOOD, **r}.get(c, "") for c in header)) for r in rows]
    return "\n".join(lines) + "\n"


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def put(name, text, encoding="utf-8"):
        target = folder / name
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(text.encode(encoding))
        return target

    put.folder, put.out = str(folder), str(tmp_path / "out")
    return put


def run(spark, drop, **options):
    return ingest(spark, drop.folder, drop.out, user="teste", **options)


def history(spark, store):
    return {
        r.tabela_origem: (r.status, r.linhas_processadas, r.linhas_inseridas, r.linhas_erro)
        for r in store.read_history(spark).collect()
    }


def log(spark, store):
    rows = store.read_rejections(spark).collect()
    return sorted((r.severidade, r.numero_linha, r.campo_falha, r.motivo_rejeicao, r.valor_recebido) for r in rows)


def loaded(spark, store, spec=FATURAMENTO):
    return store.read_table(spark, spec).collect()


def test_loads_types_and_logs(spark, drop):
    drop(
        "Faturamento_marco.csv",
        billing(
            {},
            {"valor_da_conta": "abc", "data_fat": "31/02/2024"},
            {"vencimento": "99/99/2024", "cnpj": " "},
            {"empresa": "NA", "numero_documento": ""},
        )
        + ";".join(FATURAMENTO.header)
        + "\n",
    )
    store = run(spark, drop)
    rows = sorted(loaded(spark, store), key=lambda r: r.numero_documento or "")
    assert [(r.numero_documento, r.empresa) for r in rows] == [(None, None), ("1", "Alfa")]
    good = rows[1]
    assert good.valor_da_conta == Decimal("1000.50") and good.data_fat == dt.date(2024, 3, 5)
    assert (good.cliente_nome_fantasia, good.categoria) == ("Loja", "K")
    assert good.source_filename == "Faturamento_marco.csv" and good.data_carga is not None
    assert log(spark, store) == [
        ("ERROR", 3, "valor_da_conta", "Valor numérico inválido em 'valor_da_conta': abc", "abc"),
        ("ERROR", 4, "vencimento", "Data inválida em 'vencimento': 99/99/2024", "99/99/2024"),
        ("ERROR", 6, "valor_da_conta", "Valor numérico inválido em 'valor_da_conta': valor_da_conta", "valor_da_conta"),
        ("WARN", 4, "cnpj", "Campos obrigatórios vazios: cnpj", None),
        ("WARN", 5, "numero_documento, empresa", "Campos obrigatórios vazios: numero_documento, empresa", None),
    ]
    assert history(spark, store) == {"Faturamento_marco.csv": ("sucesso", 5, 2, 5)}
    entry = store.read_rejections(spark).filter("numero_linha = 3").first()
    run_row = store.read_history(spark).first()
    assert entry.execucao_fk == run_row.id and len(run_row.id) == 36
    assert entry.script_nome == run_row.script_nome == "ingest_faturamento"
    assert '"valor_da_conta":"abc"' in entry.registro_completo and '"parcela":null' in entry.registro_completo
    assert (run_row.camada, run_row.tabela_destino, run_row.usuario_executante) == ("bronze", "faturamento", "teste")
    assert run_row.linhas_atualizadas == 0 and run_row.data_fim >= run_row.data_inicio


def test_separators_and_encodings_load_the_same(spark, drop):
    row = {"observacao": "ação"}
    drop("faturamento_a.csv", billing(row))
    drop("faturamento_b.csv", billing(row, sep=","))
    drop("faturamento_c.csv", billing(row, sep="\t"))
    drop("faturamento_d.csv", billing(row) + billing(row).split("\n")[1] + "\n", "latin-1")
    rows = loaded(spark, run(spark, drop))
    assert len(rows) == 5
    names = [f for f in FATURAMENTO.target.fieldNames()]
    assert len({tuple(r[n] for n in names) for r in rows}) == 1


@pytest.mark.parametrize(
    "header",
    [
        FATURAMENTO.header[1:],
        (*FATURAMENTO.header, "extra"),
        (FATURAMENTO.header[1], FATURAMENTO.header[0], *FATURAMENTO.header[2:]),
        (FATURAMENTO.header[0].upper(), *FATURAMENTO.header[1:]),
    ],
    ids=["missing", "extra", "reordered", "case"],
)
def test_wrong_header_fails_the_file_only(spark, drop, header):
    drop("faturamento_ruim.csv", billing({}, header=header))
    drop("faturamento_bom.csv", billing({}))
    store = run(spark, drop)
    assert history(spark, store) == {"faturamento_ruim.csv": ("erro", 0, 0, 0), "faturamento_bom.csv": ("sucesso", 1, 1, 0)}
    assert len(loaded(spark, store)) == 1
    failed = store.read_history(spark).filter("status = 'erro'").first()
    assert failed.mensagem_erro.startswith("Cabeçalho fora do contrato")
    # A failed file may come again, and fails again.
    store = run(spark, drop)
    assert store.read_history(spark).count() == 3


def test_equal_content_counts_once(spark, drop):
    drop("faturamento_1.csv", billing({}))
    drop("faturamento_2.csv", billing({}))
    drop("faturamento_outro.csv", billing({"numero_documento": "2"}))
    store = run(spark, drop)
    assert set(history(spark, store)) == {"faturamento_1.csv", "faturamento_outro.csv"}
    drop("faturamento_3.csv", billing({}))
    assert set(history(spark, run(spark, drop))) == {"faturamento_1.csv", "faturamento_outro.csv"}
    assert len(loaded(spark, store)) == 2


def test_delivering_a_file_again_replaces_its_rows(spark, drop):
    drop("faturamento_x.csv", billing({}, {"numero_documento": "2"}))
    drop("faturamento_y.csv", billing({"numero_documento": "3"}))
    run(spark, drop)
    drop("faturamento_x.csv", billing({"numero_documento": "4"}))
    store = run(spark, drop)
    assert sorted(r.numero_documento for r in loaded(spark, store)) == ["3", "4"]
    drop("faturamento_x.csv", billing({"valor_da_conta": "?"}))
    store = run(spark, drop)
    assert [r.numero_documento for r in loaded(spark, store)] == ["3"]
    assert store.read_history(spark).count() == 4


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_same_name_in_several_folders_keeps_the_last(spark, drop, files_per_batch):
    for i in range(1, 5):
        drop(f"{i}/faturamento.csv", billing({"numero_documento": str(i), "cnpj": ""}))
    store = ingest(spark, f"{drop.folder}/*", drop.out, files_per_batch=files_per_batch)
    assert [r.numero_documento for r in loaded(spark, store)] == ["4"]
    assert [r.status for r in store.read_history(spark).collect()] == ["sucesso"] * 4
    assert store.read_rejections(spark).count() == 4


def test_small_and_odd_files(spark, drop):
    drop("faturamento_cabecalho.csv", billing())
    drop("faturamento_vazio.csv", "")
    drop("outro.csv", billing({}))
    drop("faturamento.txt", billing({}))
    drop("usuarios_base_oficial.csv", "cnpj,status,extra\n1,Ativo,x\n")
    store = run(spark, drop)
    assert history(spark, store) == {
        "faturamento_cabecalho.csv": ("sucesso", 0, 0, 0),
        "usuarios_base_oficial.csv": ("sucesso", 1, 1, 1),
    }
    row = loaded(spark, store, BASE_OFICIAL)[0]
    assert (row.cnpj, row.status, row.grupo) == ("1", "Ativo", None)
    entry = store.read_rejections(spark).first()
    absent = [c for c in BASE_OFICIAL.mandatory if c not in ("cnpj", "status")]
    assert entry.campo_falha == ", ".join(absent)
    assert entry.registro_completo == '{"cnpj":"1","status":"Ativo","extra":"x"}'
    assert loaded(spark, store, USUARIOS) == []


def test_batches_and_large_files_give_the_same(spark, drop):
    for i in range(5):
        drop(f"faturamento_{i}.csv", billing(*[{"numero_documento": f"{i}-{j}", "observacao": "a\nb"} for j in range(4)]).replace("a\nb", '"a\nb"'))
    store = run(spark, drop, files_per_batch=2, whole_file_bytes=10)
    assert len(loaded(spark, store)) == 20
    assert {r.observacao for r in loaded(spark, store)} == {"a\nb"}
    assert set(history(spark, store).values()) == {("sucesso", 4, 4, 0)}
    assert run(spark, drop, files_per_batch=3, whole_file_bytes=10).read_history(spark).count() == 5


def test_a_failing_load_is_an_error_and_does_not_stop_others(spark, drop, monkeypatch):
    drop("faturamento_1.csv", billing({}))
    drop("usuarios_1.csv", ",".join(USUARIOS.header) + "\n" + ",".join("x" * len(USUARIOS.header)) + "\n")
    original = ingest_module.stage_rows

    def broken(valid, path, load, cluster=()):
        if path.endswith("faturamento"):
            raise RuntimeError("disco cheio")
        return original(valid, path, load, cluster)

    monkeypatch.setattr(ingest_module, "stage_rows", broken)
    store = run(spark, drop)
    assert history(spark, store) == {"faturamento_1.csv": ("erro", 1, 0, 0), "usuarios_1.csv": ("sucesso", 1, 1, 0)}
    monkeypatch.undo()
    run(spark, drop)
    assert len(loaded(spark, store)) == 1


def test_stream_takes_in_what_is_new(spark, drop, tmp_path):
    def go():
        ingest_stream(spark, drop.folder, drop.out, str(tmp_path / "progress"), max_files_per_trigger=2)

    for i in range(3):
        drop(f"faturamento_{i}.csv", billing({"numero_documento": str(i)}))
    go()
    go()
    drop("faturamento_9.csv", billing({"numero_documento": "9"}))
    drop("faturamento_copia.csv", billing({"numero_documento": "0"}))
    go()
    store = ingest_module.Store(drop.out)
    assert sorted(r.numero_documento for r in loaded(spark, store)) == ["0", "1", "2", "9"]
    assert store.read_history(spark).count() == 4


def test_stream_takes_in_a_file_that_comes_again_under_its_name(spark, drop, tmp_path):
    def go():
        ingest_stream(spark, drop.folder, drop.out, str(tmp_path / "progress"))

    drop("faturamento_1.csv", billing({"numero_documento": "1"}))
    drop("faturamento_2.csv", billing({"numero_documento": "2"}))
    go()
    again = drop("faturamento_1.csv", billing({"numero_documento": "3"}))  # of the same length
    os.utime(again, (1, 1))
    go()
    go()
    store = ingest_module.Store(drop.out)
    assert sorted(r.numero_documento for r in loaded(spark, store)) == ["2", "3"]
    assert store.read_history(spark).count() == 3


def test_counts_add_up(spark, drop):
    rows = [{"numero_documento": str(i), "valor_da_conta": "x" if i % 3 == 0 else "1,0", "cnpj": "" if i % 4 == 0 else "1"} for i in range(50)]
    drop("faturamento_1.csv", billing(*rows[:30]))
    drop("faturamento_2.csv", billing(*rows[30:]))
    store = run(spark, drop)
    errors = {r.execucao_fk: r["count"] for r in store.read_rejections(spark).filter("severidade = 'ERROR'").groupBy("execucao_fk").count().collect()}
    warns = {r.execucao_fk: r["count"] for r in store.read_rejections(spark).filter("severidade = 'WARN'").groupBy("execucao_fk").count().collect()}
    for r in store.read_history(spark).collect():
        assert r.linhas_processadas == r.linhas_inseridas + errors.get(r.id, 0)
        assert r.linhas_erro == errors.get(r.id, 0) + warns.get(r.id, 0)


def test_a_file_that_ends_inside_quotes_is_refused_and_replaces_nothing(spark, drop):
    text = billing(*({"numero_documento": str(i)} for i in range(1, 6)))
    drop("faturamento_x.csv", text)
    drop("faturamento_y.csv", billing({"numero_documento": "7", "categorioa": 'a;""b""\nc'}))
    run(spark, drop)
    head, first, *rest = text.split("\n")
    drop("faturamento_x.csv", "\n".join([head, first, '"' + rest[0], *rest[1:]]))
    store = run(spark, drop)
    assert sorted(r.numero_documento for r in loaded(spark, store)) == ["1", "2", "3", "4", "5", "7"]
    states = store.read_history(spark).select("status", "linhas_inseridas", "mensagem_erro").collect()
    assert sorted((r.status, r.linhas_inseridas) for r in states) == [("erro", 0), ("sucesso", 1), ("sucesso", 5)]
    assert [r.mensagem_erro for r in states if r.status == "erro"] == [ingest_module.UNCLOSED]


@pytest.mark.parametrize("block", [None, 64])
def test_a_large_file_that_ends_inside_quotes_is_refused_and_replaces_nothing(spark, drop, settings, block):
    conf = {"spark__sql__files__maxPartitionBytes": str(block), "spark__sql__files__openCostInBytes": "1"} if block else {}
    with settings(**conf):
        text = billing(*({"numero_documento": str(i)} for i in range(1, 6)))
        drop("faturamento_x.csv", text)
        drop("faturamento_y.csv", billing({"numero_documento": "7", "categorioa": 'a;""b""\nc'}))
        run(spark, drop, whole_file_bytes=0)
        head, first, *rest = text.split("\n")
        drop("faturamento_x.csv", "\n".join([head, first, '"' + rest[0], *rest[1:]]))
        drop("faturamento_z.csv", "\n".join([head, first, '"' + rest[0], 'a"', rest[1].replace("1", "8"), ""]))
        store = run(spark, drop, whole_file_bytes=0)
        states = {(r.tabela_origem, r.status, r.mensagem_erro) for r in store.read_history(spark).collect()}
        numbers = [r.numero_documento for r in loaded(spark, store) if r.source_filename == "faturamento_x.csv"]
    assert sorted(numbers) == ["1", "2", "3", "4", "5"]
    assert ("faturamento_x.csv", "erro", ingest_module.UNCLOSED) in states and ("faturamento_x.csv", "sucesso", None) in states
    assert {s[1] for s in states if s[0] in ("faturamento_y.csv", "faturamento_z.csv")} == {"sucesso"}


def test_files_of_one_name_fail_together(spark, drop, monkeypatch):
    for i in range(1, 4):
        drop(f"{i}/faturamento.csv", billing({"numero_documento": str(i)}))
    monkeypatch.setattr(ingest_module, "stage_rows", lambda *a, **k: 1 / 0)
    store = ingest(spark, f"{drop.folder}/*", drop.out, files_per_batch=1)
    assert loaded(spark, store) == []
    assert [(r.status, r.linhas_inseridas) for r in store.read_history(spark).collect()] == [("erro", 0)] * 3


@pytest.mark.parametrize("step", ["append_rejections", "commit_events"])
def test_a_load_killed_before_its_end_leaves_nothing(spark, drop, monkeypatch, step):
    """Rows and log entries come into force together, when the end events are written; a retried run logs once."""
    drop("faturamento_1.csv", billing({"numero_documento": "1"}, {"cnpj": ""}))
    store = run(spark, drop)
    drop("faturamento_1.csv", billing({"numero_documento": "2"}, {"valor_da_conta": "?"}))

    class Killed(BaseException):
        pass

    def kill(*args, **kwargs):
        raise Killed

    monkeypatch.setattr(ingest_module, step, kill)
    with pytest.raises(Killed):
        run(spark, drop)
    monkeypatch.undo()
    assert sorted(r.numero_documento for r in loaded(spark, store)) == ["1", "1"]
    assert [e[0] for e in log(spark, store)] == ["WARN"]
    assert sorted(r.status for r in store.read_history(spark).collect()) == ["em_execucao", "sucesso"]
    run(spark, drop)
    assert [r.numero_documento for r in loaded(spark, store)] == ["2"]
    assert [e[0] for e in log(spark, store)] == ["ERROR", "WARN"]


def corrupt(path):
    """Spoil the checksums that the local file system keeps beside a file: reading it then fails."""
    path.with_name(f".{path.name}.crc").write_bytes(b"crc\0\0\0\2\0" + b"\1\2\3\4" * (1 + path.stat().st_size // 512))


@pytest.mark.parametrize("whole", [10**6, 0])
def test_an_unreadable_file_fails_alone(spark, drop, tmp_path, whole):
    for i in range(1, 4):
        target = drop(f"faturamento_{i}.csv", billing({"numero_documento": str(i)}))
    corrupt(drop("faturamento_2.csv", billing({"numero_documento": "2"})))
    progress = str(tmp_path / "progress")
    store = ingest_stream(spark, drop.folder, drop.out, progress, whole_file_bytes=whole)
    assert sorted(r.numero_documento for r in loaded(spark, store)) == ["1", "3"]
    states = history(spark, store)
    assert states["faturamento_2.csv"] == ("erro", 0, 0, 0) and {s[0] for s in states.values()} == {"erro", "sucesso"}
    failed = store.read_history(spark).filter("status = 'erro'").first()
    assert failed.file_hash is None and failed.mensagem_erro and failed.tabela_destino == "faturamento"
    target.with_name(".faturamento_2.csv.crc").unlink()  # readable again: tried again, though it is the same delivery
    ingest_stream(spark, drop.folder, drop.out, progress, whole_file_bytes=whole)
    assert sorted(r.numero_documento for r in loaded(spark, store)) == ["1", "2", "3"]


def test_a_file_that_fails_while_it_is_staged_fails_alone(spark, drop, monkeypatch):
    for i in range(1, 6):
        drop(f"faturamento_{i}.csv", billing({"numero_documento": str(i)}))
    original = ingest_module.stage

    def gone(spark, files, spec, run):
        if any(f.path.endswith("_4.csv") for f in files):
            raise OSError("sumiu")
        return original(spark, files, spec, run)

    monkeypatch.setattr(ingest_module, "stage", gone)
    store = run(spark, drop)
    assert sorted(r.numero_documento for r in loaded(spark, store)) == ["1", "2", "3", "5"]
    assert {k: v[0] for k, v in history(spark, store).items() if v[0] != "sucesso"} == {"faturamento_4.csv": "erro"}


def test_folders_are_per_load_and_deliveries_per_file_that_is_there(spark, drop, tmp_path):
    progress = tmp_path / "progress"
    for i in range(12):
        drop(f"faturamento_{i}.csv", billing({"numero_documento": str(i)}))
    store = ingest_stream(spark, drop.folder, drop.out, str(progress))
    assert len(list(Path(store.table(FATURAMENTO), "linhas").glob("carga=*"))) == 1
    for i in range(10):
        Path(drop.folder, f"faturamento_{i}.csv").unlink()
    drop("faturamento_novo.csv", billing({"numero_documento": "novo"}))
    ingest_stream(spark, drop.folder, drop.out, str(progress))
    kept = [f for f in progress.glob("deliveries/*") if f.is_dir()]
    assert [f.name for f in kept] == ["base-2"] and spark.read.parquet(str(kept[0])).count() == 3
    assert len(loaded(spark, store)) == 13


def test_one_unreadable_file_of_many_costs_one_more_pass(spark, drop, monkeypatch):
    """Halving the files down to it described them about twice more, in some 2 log n jobs."""
    for i in range(20):
        path = drop(f"faturamento-{i:02}.csv", billing({"numero_documento": str(i)}))
    corrupt(path)
    seen, build = [], ingest_module.build_manifest

    def counted(session, paths, *rest):
        seen.append(paths)
        return build(session, paths, *rest)

    monkeypatch.setattr(ingest_module, "build_manifest", counted)
    store = run(spark, drop)
    assert sorted(s[0] for s in history(spark, store).values()) == ["erro"] + ["sucesso"] * 19
    assert len(loaded(spark, store)) == 19
    assert len(seen) == 3 and len(seen[2]) == 1


@pytest.mark.parametrize("before", [None, "20000"])
def test_staging_keeps_generated_methods_small_enough_to_be_compiled(spark, drop, monkeypatch, before):
    name, held, write = "spark.sql.codegen.hugeMethodLimit", {}, ingest_module.materialize

    def noted(df, path, *rest):
        held[path.rsplit("/", 1)[1].split("-")[0]] = spark.conf.get(name, None)
        return write(df, path, *rest)

    monkeypatch.setattr(ingest_module, "materialize", noted)
    if before is not None:
        spark.conf.set(name, before)
    usual = spark.conf.get(name, None)
    try:
        drop("faturamento.csv", billing({}))
        assert len(loaded(spark, run(spark, drop))) == 1
        assert held["staged"] == "8000" and held["plan"] == usual
        assert spark.conf.get(name, None) == usual
    finally:
        spark.conf.unset(name)


def test_only_flagged_rows_carry_a_run_id(spark, drop):
    """Hashing the id for every row took a fifth of staging; only log entries need it."""
    from rawlane.sources.manifest import build_manifest, route_files

    drop("faturamento.csv", billing({}, {"cnpj": ""}, {"valor_da_conta": "?"}))
    files = route_files(build_manifest(spark, drop.folder)).collect()
    rows = ingest_module.stage(spark, files, FATURAMENTO, "r").select("registro", "run_id").collect()
    assert sorted(r.run_id is not None for r in rows) == [False, True, True]
    assert all((r.registro is None) == (r.run_id is None) for r in rows)


def test_many_files_are_looked_up_by_few_tasks(spark, drop, monkeypatch):
    """A list of files took a task for each."""
    from rawlane.sources import delimited

    name, held, read = "spark.sql.sources.parallelPartitionDiscovery.parallelism", [], delimited._read_group
    before = spark.conf.get(name, None)
    monkeypatch.setattr(delimited, "_read_group", lambda *a: held.append(int(spark.conf.get(name))) or read(*a))
    drop("faturamento.csv", billing({}))
    assert len(loaded(spark, run(spark, drop))) == 1
    assert held == [4 * spark.sparkContext.defaultParallelism] and spark.conf.get(name, None) == before


def test_a_task_writes_several_files_of_the_drop_folder(spark, tmp_path):
    """Every file holds the rows of its keys, whether or not all of them are there; full ones share tasks."""
    from pyspark.sql import functions as F

    from rawlane_checks.intake import drop_folder
    from rawlane_checks.registry import Tables
    from rawlane_checks.sources import ROWS_PER_FILE

    full, sparse = 4 * 2 * spark.sparkContext.defaultParallelism, 3
    key = F.col("id")
    # After the full files: a gap, then files that lack rows.
    kept = spark.range((full + sparse + 5) * ROWS_PER_FILE).where((key < full * ROWS_PER_FILE) | ((key >= (full + 5) * ROWS_PER_FILE) & (key % 7 > 0)))
    price, day = F.lit(1.5), F.lit("2024-01-02").cast("timestamp")
    kept.select(key.alias("o_orderkey"), key.alias("o_custkey"), F.lit("F").alias("o_orderstatus"), price.alias("o_totalprice"), day.alias("o_orderdate")).write.parquet(str(tmp_path / "orders.parquet"))
    files = list(Path(drop_folder(Tables(spark, str(tmp_path)))).glob("*.csv"))
    assert len(files) == full + sparse and len({f.name for f in files}) == len(files)
    assert any(f.name.endswith("-c001.csv") for f in files)
    sizes = []
    for file in files:
        lines = file.read_bytes().decode("latin-1").splitlines()[1:]
        # every 67th document has no number
        keys = [int(cell) for line in lines if (cell := line.replace(",", ";").split(";")[1])]
        assert len({k // ROWS_PER_FILE for k in keys}) == 1 and keys == sorted(keys)
        sizes.append(len(lines))
    assert sorted(sizes)[sparse:] == [ROWS_PER_FILE] * full and sum(sizes) == kept.count()
