"""Entity contracts: source key, LAND column name and TRUSTED type of every field.

One declaration per entity replaces the three hand-kept lists of the
reference (rename map, RAW column list, TRUSTED cast list). LAND names come
from the camelCase -> snake_case rule plus a short table of irregular names.
Type words: string, long, double, bool, year (date from '%Y'), dmy (date
from '%d/%m/%Y'), safe_long (float text rounded to a 64-bit integer or
NULL), timestamp.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from laminar.functions import camel_to_snake
from laminar.functions.casts import cast_sql, quote, result_type

STAMP = "partition_time"
MONTH = "load_month"

_SPARK_TO_WORD = {
    T.LongType: "long", T.IntegerType: "long", T.ShortType: "long", T.ByteType: "long",
    T.DoubleType: "double", T.FloatType: "double", T.StringType: "string",
    T.BooleanType: "bool", T.TimestampType: "timestamp", T.TimestampNTZType: "timestamp",
    T.DateType: "date",
}


@dataclass(frozen=True)
class Field:
    source: str
    land: str
    kind: str


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    cluster_key: str

    @property
    def land_columns(self) -> list[str]:
        return [f.land for f in self.fields]

    @property
    def rename_map(self) -> dict[str, str]:
        return {f.source: f.land for f in self.fields}

    def source_schema(self) -> T.StructType:
        """Payload keys, every value read as text (no inference)."""
        return T.StructType([T.StructField(f.source, T.StringType()) for f in self.fields])

    def land_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.land_columns]
                            + [T.StructField(STAMP, T.TimestampType())])

    def check(self, df: DataFrame, columns: list[str] | None = None) -> None:
        """Fail listing the difference when ``df`` does not have exactly the contract columns."""
        expected = columns or self.land_columns
        have = [c for c in df.columns if c not in (STAMP, MONTH)]
        missing = [c for c in expected if c not in have]
        extra = [c for c in have if c not in expected]
        if missing or extra:
            raise ContractError(f"{self.name}: missing {missing}, unexpected {extra}")

    def trusted_schema(self) -> T.StructType:
        """Types after the casts, plus the stamp."""
        return T.StructType([T.StructField(f.land, result_type(f.kind)) for f in self.fields] + [T.StructField(STAMP, T.TimestampType())])

    def typed_sql(self, tolerant: bool = False) -> list[str]:
        """The TRUSTED projection as SQL expressions, for ``DataFrame.selectExpr``."""
        return [f"{cast_sql(f.land, f.kind, tolerant)} AS {quote(f.land)}" for f in self.fields]

    def typed(self, df: DataFrame, *keep: str, tolerant: bool = False) -> DataFrame:
        """``df`` with every contract field cast, plus the ``keep`` columns unchanged."""
        return df.selectExpr(*self.typed_sql(tolerant), *[quote(k) for k in keep])

    @classmethod
    def from_text(cls, name: str, spec: str, cluster_key: str,
                  irregular: dict[str, str] | None = None) -> "Contract":
        """Parse lines of ``type: key key ...`` in field order."""
        irregular = irregular or {}
        fields = []
        for line in spec.strip().splitlines():
            kind, keys = line.split(":", 1)
            for key in keys.split():
                fields.append(Field(key, irregular.get(key, camel_to_snake(key)), kind.strip()))
        return cls(name, tuple(fields), cluster_key)

    @classmethod
    def from_schema(cls, name: str, schema: T.StructType, cluster_key: str) -> "Contract":
        """A contract whose LAND names are the table's own column names."""
        fields = []
        for f in schema.fields:
            word = _SPARK_TO_WORD.get(type(f.dataType))
            if word is None:
                raise ContractError(f"{name}.{f.name}: no contract type for {f.dataType}")
            fields.append(Field(f.name, f.name, word))
        return cls(name, tuple(fields), cluster_key)


# The school payload (135 keys) in source order, grouped into
# runs of one TRUSTED type.
SCHOOL_SPEC = """
string: cod
year: anoCenso
string: nome
long: situacaoFuncionamento situacaoCenso
string: inicioAno fimAno
long: codUf
string: siglaUf codMunicipio nomeMunicipio
long: codDistrito
string: nomeDistrito regiao
long: dependenciaAdministrativa tipoLocalizacao regulamentada
bool: aguaFiltrada aguaPublica aguaPocoArtesiano aguaCacimba aguaRio aguaInexistente
bool: energiaPublica energiaGerador energiaOutros energiaInexistente
bool: esgotoPublico esgotoFossa esgotoInexistente
bool: lixoColetaPeriodica lixoQueima lixoJogaOutraArea lixoRecicla lixoEnterra lixoOutros
bool: salaDiretoria salaProfessores laboratorioInformatica laboratorioCiencias atendimentoEspecial
bool: quadraCoberta quadraDescoberta cozinha biblioteca salaLeitura parqueInfantil bercario
bool: sanitarioForaPredio sanitarioDentroPredio sanitarioEducInfant sanitarioPNE dependenciasPNE
bool: secretaria banheiroChuveiro refeitorio despensa almoxarifado auditorio patioCoberto
bool: patioDescoberto alojamentoAluno alojamentoProfessor areaVerde lavanderia
long: salasExistentes salasUtilizadas televisores videoCassetes dvds parabolicas copiadoras
long: retroprojetores impressoras aparelhosSom datashows fax foto computadores computadoresAdm
long: computadoresAlunos
bool: internet bandaLarga
long: funcionarios
bool: alimentacao aee
long: atividadeComplementar
bool: ensinoRegular regCreche regPreescola regFundamental8 regFundamental9 regMedioMedio
bool: regMedioIntegrado regMedioNormal regMedioProfissional ensinoEspecial espCreche espPreescola
bool: espFundamental8 espFundamental9 espMedioMedio espMedioIntegrado espMedioNormal
bool: espMedioProfissional espEjaFundamental espEjaMedio ensinoEja ejaFundamental ejaMedio
bool: ejaProjovem ciclos fimDeSemana pedagogiaAlternancia
double: idebAI idebAF enemPortugues enemMatematica enemHumanas enemNaturais enemRedacao
double: enemMediaObjetiva enemMediaGeral
string: socioEconomico
double: formacaoDocente
string: endereco latitude longitude nomeTitulo situacaoFuncionamentoTxt
dmy: inicioAnoTxt fimAnoTxt
string: dependenciaAdministrativaTxt tipoLocalizacaoTxt regulamentadaTxt
"""

# School LAND names that do not follow the camelCase rule.
SCHOOL_IRREGULAR = {
    "datashows": "data_shows",
    "regFundamental9": "reg_fundamental19",
    "ejaProjovem": "eja_pro_jovem",
}

# The state statistics payload (100 keys) in source order.
STATISTICS_SPEC = """
string: id
long: ano
string: tipoLocal nomeLocal
long: codMunicipio melhores
double: situacaoFuncionamentoAtividade situacaoFuncionamentoParalisada
double: situacaoFuncionamentoExtinta situacaoFuncionamentoExtintaAnoAnterior
double: situacaoFuncionamentoNaoInformado dependenciaAdministrativaFederal
double: dependenciaAdministrativaEstadual dependenciaAdministrativaMunicipal
double: dependenciaAdministrativaPrivada tipoLocalizacaoRural tipoLocalizacaoUrbana
double: regulamentadaSim regulamentadaNao regulamentadaTramitacao
double: aguaFiltrada aguaPublica aguaPocoArtesiano aguaCacimba aguaRio aguaInexistente
double: aguaNaoInformado energiaPublica energiaGerador energiaOutros energiaInexistente
double: energiaNaoInformado esgotoPublico esgotoFossa esgotoInexistente esgotoNaoInformado
double: lixoColetaPeriodica lixoQueima lixoJogaOutraArea lixoRecicla lixoEnterra lixoOutros
double: lixoNaoInformado salaDiretoria salaProfessores laboratorioInformatica
double: laboratorioCiencias atendimentoEspecial quadraCoberta quadraDescoberta cozinha
double: biblioteca salaLeitura parqueInfantil bercario sanitarioForaPredio
double: sanitarioDentroPredio sanitarioEducInfant sanitarioPNE dependenciasPNE secretaria
double: banheiroChuveiro refeitorio despensa almoxarifado auditorio patioCoberto
double: patioDescoberto alojamentoAluno alojamentoProfessor areaVerde lavanderia
double: salasExistentes salasUtilizadas televisores videoCassetes dvds parabolicas
double: copiadoras retroprojetores impressoras aparelhosSom datashows fax foto computadores
double: computadoresAdm computadoresAlunos internet bandaLarga idebAI idebAF enemPortugues
double: enemMatematica enemHumanas enemNaturais enemRedacao enemMediaObjetiva enemMediaGeral
double: formacaoDocente
"""

# Infrastructure fields. The source names are the payload
# paths of the flattened record (``id`` is never produced by the extract).
INFRASTRUCTURE_FIELDS = (
    Field("id", "id", "string"),
    Field("section", "secao", "string"),
    Field("label", "tema", "string"),
    Field("entidade", "entidade", "string"),
    Field("value", "porcentagem", "double"),
    Field("escolas", "escolas", "safe_long"),
    Field("slug", "sigla_uf", "string"),
    Field("qtd_escolas", "total_escolas", "long"),
    Field("ano", "ano", "long"),
    Field("tipo_escolas", "tipo_escolas", "string"),
)

SCHOOLS = Contract.from_text("escolas", SCHOOL_SPEC, "cod", SCHOOL_IRREGULAR)
STATISTICS = Contract.from_text("estatisticas", STATISTICS_SPEC, "id")
INFRASTRUCTURE = Contract("infraestrutura", INFRASTRUCTURE_FIELDS, "id")
