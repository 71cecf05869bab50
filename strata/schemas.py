"""Raw layouts, column specs and fixed domain values.

A column spec is a list of ``(source_name, target_name, target_type)`` triples; it is
applied by ``strata.operators.projection.apply_spec`` in ONE ``select``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source pipeline's for right results.
# (field names of the raw files, the allowed segments, the quarter -> month map,
#  the name cleaning patterns, the industry pattern, the headquarters separator)
# ---------------------------------------------------------------------------
BANK_FIELDS = ["Segmento", "CNPJ", "Nome"]

COMPLAINT_FIELDS = [
    "Ano",
    "Trimestre",
    "Categoria",
    "Tipo",
    "CNPJ IF",
    "Instituição financeira",
    "Índice",
    "Quantidade de reclamações reguladas procedentes",
    "Quantidade de reclamações reguladas - outras",
    "Quantidade de reclamações não reguladas",
    "Quantidade total de reclamações",
    "Quantidade total de clientes  CCS e SCR",
    "Quantidade de clientes  CCS",
    "Quantidade de clientes  SCR",
]

EMPLOYER_FIELDS = [
    "employer_name",
    "reviews_count",
    "culture_count",
    "salaries_count",
    "benefits_count",
    "employer-website",
    "employer-headquarters",
    "employer-founded",
    "employer-industry",
    "employer-revenue",
    "url",
    "Geral",
    "Cultura e valores",
    "Diversidade e inclusão",
    "Qualidade de vida",
    "Alta liderança",
    "Remuneração e benefícios",
    "Oportunidades de carreira",
    "Recomendam para outras pessoas(%)",
    "Perspectiva positiva da empresa(%)",
    "Segmento",
    "Nome",
    "match_percent",
]

SEGMENTS = ["S1", "S2", "S3", "S4", "S5"]
QUARTER_LAST_MONTH = {"1": "03", "2": "06", "3": "09", "4": "12"}
UNKNOWN_QUARTER_MONTH = "00"
PRUDENTIAL_SUFFIX = " - PRUDENCIAL"
CONGLOMERATE_SUFFIX = r" \(conglomerado\)"
ORDINAL_MARK = "º"
ACCENT_FOLD = ("Ô", "O")
INDUSTRY_PATTERN = r"\/.+\/(.+)\..,"
HEADQUARTERS_SEP = ", "
# File-name routing of landed files: first match wins.
ROUTES = [("bancos", ".*Bancos.*"), ("reclamacoes", ".*Reclamacoes.*"),
          ("empregados", ".*Empregados.*")]

# Raw separators / header behaviour per dataset.
RAW_FORMATS = {
    "bancos": {"sep": "\t", "fields": BANK_FIELDS},
    "reclamacoes": {"sep": ";", "fields": COMPLAINT_FIELDS},
    "empregados": {"sep": "|", "fields": EMPLOYER_FIELDS},
}


def all_string_schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])



# ---------------------------------------------------------------------------
# Trusted-layer specs (source column -> target column, type).
# The trusted and report column names and types must equal the
# source pipeline's, in its order.
# ---------------------------------------------------------------------------
BANK_SPEC = [
    ("Segmento", "nom_segto_instituicao", "string"),
    ("CNPJ", "num_cnpj_instituicao", "bigint"),
    ("Nome", "nom_instituicao", "string"),
]

COMPLAINT_SPEC = [
    ("Ano", "ano", "int"),
    ("Trimestre", "num_trimestre", "int"),
    ("Categoria", "nom_categoria", "string"),
    ("Tipo", "nom_tipo_instituicao", "string"),
    ("CNPJ IF", "num_cnpj_instituicao", "bigint"),
    ("Instituição financeira", "nom_instituicao", "string"),
    ("Índice", "vlr_ind_recl", "float"),
    ("Quantidade de reclamações reguladas procedentes", "qtd_recl_reg_prec", "bigint"),
    ("Quantidade de reclamações reguladas - outras", "qtd_recl_reg_outr", "bigint"),
    ("Quantidade de reclamações não reguladas", "qtd_recl_nao_reg", "bigint"),
    ("Quantidade total de reclamações", "qtd_totl_recl", "bigint"),
    ("Quantidade total de clientes  CCS e SCR", "qtd_totl_clie_css_scr", "bigint"),
    ("Quantidade de clientes  CCS", "qtd_clie_ccs", "bigint"),
    ("Quantidade de clientes  SCR", "qtd_clie_scr", "bigint"),
    ("anomesdia", "anomesdia", "string"),
]

EMPLOYER_SPEC = [
    ("reviews_count", "qtd_aval", "int"),
    ("culture_count", "qtd_aval_cult", "int"),
    ("salaries_count", "qtd_aval_salr", "int"),
    ("benefits_count", "qtd_aval_benef", "int"),
    ("employer-website", "txt_url_instituicao", "string"),
    ("employer-headquarters-city", "nom_mun_sede_instituicao", "string"),
    ("employer-headquarters-country", "nom_pais_sede_instituicao", "string"),
    ("employer-founded", "ano_fund_instituicao", "int"),
    ("employer-industry", "nom_segto_atua_instituicao", "string"),
    ("employer-revenue", "txt_faixa_rend_instituicao", "string"),
    ("url", "txt_url_orig_data", "string"),
    ("Geral", "vlr_ind_satis_geral", "float"),
    ("Cultura e valores", "vlr_ind_cult_valrs", "float"),
    ("Diversidade e inclusão", "vlr_ind_divr_incl", "float"),
    ("Qualidade de vida", "vlr_ind_qual_vida", "float"),
    ("Alta liderança", "vlr_ind_alt_lider", "float"),
    ("Remuneração e benefícios", "vlr_ind_remu_bene", "float"),
    ("Oportunidades de carreira", "vlr_ind_oprt_carr", "float"),
    ("Recomendam para outras pessoas(%)", "vlr_pct_recom_outr_pess", "float"),
    ("Perspectiva positiva da empresa(%)", "vlr_pct_perspec_pos_instituicao", "float"),
    ("Nome", "nom_instituicao", "string"),
]

# Report column names (fixed values): internal -> (snapshot name, display name, type)
REPORT_SPEC = [
    ("nom_instituicao", "nome_banco", "Nome do Banco", "string"),
    ("num_cnpj_instituicao", "cnpj", "CNPJ", "bigint"),
    ("nom_segto_instituicao", "classificacao_banco", "Classificação do Banco", "string"),
    ("max_qtd_totl_clie_ccs_scr", "quantidade_clientes_banco",
     "Quantidade de Clientes do Bancos", "int"),
    ("avg_ind_recl", "indice_reclamacoes", "Índice de reclamações", "float"),
    ("sum_qtd_totl_recl", "quantidade_reclamacoes", "Quantidade de reclamações", "int"),
    ("avg_ind_geral_instituicao", "indice_satisfacao_funcionarios_bancos",
     "Índice de satisfação dos funcionários dos bancos", "float"),
    ("avg_ind_remu_bene_instituicao", "indice_satisfação_salarios_funcionarios_bancos",
     "Índice de satisfação com salários dos funcionários dos bancos", "float"),
]


def report_spec(style: str = "snapshot") -> list[tuple[str, str, str]]:
    """``style`` = 'snapshot' (file report names), 'display' (database report names) or
    'internal' (text report: internal names, counts and means in full width)."""
    if style == "internal":
        wide = {"int": "bigint", "float": "double"}
        return [(row[0], row[0], wide.get(row[3], row[3])) for row in REPORT_SPEC]
    pick = {"snapshot": 1, "display": 2}[style]
    return [(row[0], row[pick], row[3]) for row in REPORT_SPEC]
