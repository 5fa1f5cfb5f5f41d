"""Dataset contracts: header, mandatory columns, renames and target types."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

NUMERIC_TYPES = (T.DecimalType, T.FloatType, T.DoubleType)
DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class DatasetSpec:
    """One kind of input file and the table it feeds.

    ``header`` is the exact header the file must carry; ``None`` means the dataset has no template, so the header is
    not checked and columns are matched by name. ``cluster`` names the columns loaded rows are sorted by within a file.
    """

    name: str
    pattern: str
    table: str
    target: T.StructType
    mandatory: tuple[str, ...]
    header: tuple[str, ...] | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    cluster: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for column in self.target:
            if not isinstance(column.dataType, (T.StringType, *NUMERIC_TYPES, *DATE_TYPES)):
                raise ValueError(f"{self.name}.{column.name}: {column.dataType.simpleString()} targets are not supported")
        unknown = [c for c in self.mandatory if c not in self.target.fieldNames()]
        if unknown:
            raise ValueError(f"{self.name}: mandatory columns {unknown} are not in the target")

    @property
    def script(self) -> str:
        return f"ingest_{self.name}"

    @property
    def numeric_columns(self) -> list[str]:
        return [f.name for f in self.target if isinstance(f.dataType, NUMERIC_TYPES)]

    @property
    def date_columns(self) -> list[str]:
        return [f.name for f in self.target if isinstance(f.dataType, DATE_TYPES)]


def _target(names: tuple[str, ...], rename: Mapping[str, str], money: set[str], dates: set[str]) -> T.StructType:
    fields = []
    for name in names:
        kind = MONEY if name in money else T.DateType() if name in dates else T.StringType()
        fields.append(T.StructField(rename.get(name, name), kind))
    return T.StructType(fields)


# Header contracts, mandatory columns and renames of the three datasets.
FATURAMENTO_HEADER = (
    "a_vencer_boleto_gerado",
    "numero_documento",
    "parcela",
    "nota_fiscal",
    "nome_fantasia",
    "previsao_recebimento",
    "ultimo_recebimento",
    "valor_da_conta",
    "valor_liquido",
    "impostos_retidos",
    "descontos",
    "juros_multa",
    "valor_recebido",
    "valor_a_receber",
    "categorioa",
    "operacao",
    "vendedor",
    "projeto",
    "conta_corrente",
    "numero_boleto",
    "tipo_documento",
    "vencimento",
    "data_emissao",
    "data_registro",
    "razao_social",
    "cnpj",
    "observacao",
    "ultima_alteracao",
    "incluido_por",
    "alterado_por",
    "data_fat",
    "empresa",
    "ms",
)
FATURAMENTO_RENAME = {"nome_fantasia": "cliente_nome_fantasia", "categorioa": "categoria"}
FATURAMENTO_MANDATORY = ("numero_documento", "cnpj", "data_fat", "valor_da_conta", "empresa")
FATURAMENTO_MONEY = {
    "valor_da_conta",
    "valor_liquido",
    "impostos_retidos",
    "descontos",
    "juros_multa",
    "valor_recebido",
    "valor_a_receber",
}
FATURAMENTO_DATES = {
    "previsao_recebimento",
    "ultimo_recebimento",
    "vencimento",
    "data_emissao",
    "data_registro",
    "ultima_alteracao",
    "data_fat",
}
BASE_OFICIAL_COLUMNS = (
    "cnpj",
    "status",
    "manter_no_baseline",
    "razao_social",
    "nome_fantasia",
    "canal_1",
    "canal_2",
    "lider",
    "responsavel",
    "empresa",
    "grupo",
    "corte",
    "segmento",
    "obs",
)
USUARIOS_HEADER = (
    "cargo",
    "status_vendedor",
    "consultor",
    "nivel",
    "time",
    "acesso_vendedor",
    "acesso_gerente",
    "acesso_indireto",
    "acesso_diretoria",
    "acesso_temporario",
)
USUARIOS_MANDATORY = (
    "cargo",
    "status_vendedor",
    "consultor",
    "nivel",
    "time",
    "acesso_vendedor",
    "acesso_gerente",
    "acesso_diretoria",
)

FATURAMENTO = DatasetSpec(
    name="faturamento",
    pattern="faturamento",
    table="faturamento",
    target=_target(FATURAMENTO_HEADER, FATURAMENTO_RENAME, FATURAMENTO_MONEY, FATURAMENTO_DATES),
    mandatory=FATURAMENTO_MANDATORY,
    header=FATURAMENTO_HEADER,
    rename=FATURAMENTO_RENAME,
    cluster=("empresa", "data_fat"),
)
BASE_OFICIAL = DatasetSpec(
    name="base_oficial",
    pattern="base_oficial",
    table="base_oficial",
    target=_target(BASE_OFICIAL_COLUMNS, {}, set(), set()),
    mandatory=BASE_OFICIAL_COLUMNS,
    cluster=("empresa", "grupo"),
)
USUARIOS = DatasetSpec(
    name="usuarios",
    pattern="usuarios",
    table="usuarios",
    target=_target(USUARIOS_HEADER, {}, set(), set()),
    mandatory=USUARIOS_MANDATORY,
    header=USUARIOS_HEADER,
    cluster=("time", "nivel"),
)

# Routing order: the first pattern found in the file stem wins.
DEFAULT_SPECS = (BASE_OFICIAL, FATURAMENTO, USUARIOS)

REJECTION_SCHEMA = T.StructType(
    [
        T.StructField("execucao_fk", T.StringType()),
        T.StructField("script_nome", T.StringType()),
        T.StructField("tabela_destino", T.StringType()),
        T.StructField("numero_linha", T.LongType()),
        T.StructField("campo_falha", T.StringType()),
        T.StructField("motivo_rejeicao", T.StringType()),
        T.StructField("valor_recebido", T.StringType()),
        T.StructField("registro_completo", T.StringType()),
        T.StructField("data_rejeicao", T.TimestampType()),
        T.StructField("severidade", T.StringType()),
    ]
)

# Run history is an append-only list of events; ``operators.audit.run_state`` folds it to one row per run.
RUN_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("script_nome", T.StringType()),
        T.StructField("camada", T.StringType()),
        T.StructField("tabela_origem", T.StringType()),
        T.StructField("tabela_destino", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("linhas_processadas", T.LongType()),
        T.StructField("linhas_inseridas", T.LongType()),
        T.StructField("linhas_atualizadas", T.LongType()),
        T.StructField("linhas_erro", T.LongType()),
        T.StructField("mensagem_erro", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("usuario_executante", T.StringType()),
        # Of a committed run whose rows are its file's current ones: the load that holds them.
        T.StructField("carga", T.StringType()),
    ]
)
