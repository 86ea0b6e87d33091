"""The people-data contract and the labels of its flows."""

from rosterloom.contract import ColumnSpec, TableContract

# Published names, kinds, accepted headers and order of the consolidated table.
# Consumers of the published table and the source files depend on every one of them.
PEOPLE_CONTRACT = TableContract(
    (
        # identification and time
        ColumnSpec(
            "period",
            "date",
            "periodo",
            ("COMPETENCIA", "MES_REFERENCIA", "DATA_REFERENCIA", "MES_ANO", "PERIODO"),
            description="First day of the month the row is about.",
        ),
        ColumnSpec(
            "company", "text", "empresa", ("CODCOLIGADA", "COLIGADA", "EMPRESA", "COD_EMPRESA")
        ),
        ColumnSpec("branch", "text", "filial", ("CODFILIAL", "FILIAL", "COD_FILIAL")),
        ColumnSpec(
            "person_id", "text", "matricula", ("CHAPA", "MATRICULA", "RE", "MATRICULA_RM")
        ),
        ColumnSpec(
            "month_key",
            "text",
            "CHAVE M",
            ("CHAVE M", "CHAVE_M", "CHAVEM"),
            description="Computed: period as dd/MM/yyyy, '_', person id.",
        ),
        ColumnSpec(
            "prev_month_key",
            "text",
            "CHAVE M-1",
            ("CHAVE M-1", "CHAVE_M_1", "CHAVE M 1"),
            description="Computed for leavers: the month key of the month before.",
        ),
        ColumnSpec(
            "full_name",
            "text",
            "nome",
            ("NOME", "NOME_COLABORADOR", "NOME_FUNCIONARIO", "COLABORADOR"),
        ),
        ColumnSpec("tax_id", "text", "cpf", ("CPF", "NUM_CPF"), pad=11),
        ColumnSpec(
            "birth_date",
            "date",
            "data_nascimento",
            ("DTNASCIMENTO", "DATA_NASCIMENTO", "DATA_DE_NASCIMENTO", "NASCIMENTO"),
        ),
        ColumnSpec("gender", "text", "genero", ("SEXO", "GENERO")),
        # structure
        ColumnSpec("directorate", "text", "diretoria", ("DIRETORIA", "NOME_DIRETORIA")),
        ColumnSpec("department", "text", "gerencia", ("GERENCIA", "AREA", "NOME_GERENCIA")),
        ColumnSpec(
            "cost_center",
            "text",
            "centro_custo",
            (
                "CODSECAO",
                "SECAO",
                "CENTRO_CUSTO",
                "CENTRO_DE_CUSTO",
                "CC",
                "CC_PARA",
                "SECAO_NOVA",
            ),
        ),
        ColumnSpec(
            "cost_center_name",
            "text",
            "descricao_centro_custo",
            ("DESCRICAO_SECAO", "DESC_SECAO", "DESCRICAO_CENTRO_CUSTO", "NOME_CC", "DESCRICAO_CC"),
        ),
        ColumnSpec(
            "job_title",
            "text",
            "cargo",
            ("FUNCAO", "CARGO", "NOME_FUNCAO", "DESC_FUNCAO", "FUNCAO_NOVA", "CARGO_NOVO"),
        ),
        ColumnSpec(
            "manager", "text", "gestor", ("GESTOR", "NOME_GESTOR", "LIDER", "GESTOR_IMEDIATO")
        ),
        ColumnSpec("status", "text", "situacao", ("CODSITUACAO", "SITUACAO", "STATUS")),
        ColumnSpec(
            "contract_type",
            "text",
            "tipo_contrato",
            ("CODTIPO", "TIPO_CONTRATO", "VINCULO", "TIPO_FUNCIONARIO"),
        ),
        # events
        ColumnSpec(
            "hire_date",
            "date",
            "data_admissao",
            ("DATAADMISSAO", "DATA_ADMISSAO", "DT_ADMISSAO", "ADMISSAO", "DATA_DE_ADMISSAO"),
        ),
        ColumnSpec(
            "leave_date",
            "date",
            "data_demissao",
            (
                "DATADEMISSAO",
                "DATA_DEMISSAO",
                "DT_DEMISSAO",
                "DATA_DESLIGAMENTO",
                "DESLIGAMENTO",
            ),
        ),
        ColumnSpec(
            "leave_type",
            "text",
            "tipo_demissao",
            ("TIPODEMISSAO", "TIPO_DEMISSAO", "TIPO_DESLIGAMENTO"),
        ),
        ColumnSpec(
            "leave_reason",
            "text",
            "motivo_demissao",
            ("MOTIVODEMISSAO", "MOTIVO_DEMISSAO", "MOTIVO_DESLIGAMENTO", "MOTIVO"),
        ),
        ColumnSpec(
            "movement_date",
            "date",
            "data_movimentacao",
            ("DATA_MOVIMENTACAO", "DT_MOVIMENTACAO", "DATA_ALTERACAO", "DATA_MUDANCA"),
        ),
        ColumnSpec(
            "movement_type",
            "text",
            "tipo_movimentacao",
            ("TIPO_MOVIMENTACAO", "MOTIVO_MUDANCA", "TIPO_ALTERACAO"),
        ),
        ColumnSpec(
            "prev_cost_center",
            "text",
            "centro_custo_anterior",
            ("SECAO_ANTERIOR", "CENTRO_CUSTO_ANTERIOR", "CC_ANTERIOR", "CC_DE"),
        ),
        ColumnSpec(
            "prev_job_title", "text", "cargo_anterior", ("FUNCAO_ANTERIOR", "CARGO_ANTERIOR")
        ),
        # contractors and budget
        ColumnSpec(
            "supplier", "text", "fornecedor", ("FORNECEDOR", "EMPRESA_TERCEIRA", "PRESTADORA")
        ),
        ColumnSpec(
            "slot_id",
            "text",
            "id_vaga",
            ("ID_VAGA", "VAGA", "POSICAO", "CODIGO_VAGA"),
            description="Identifier of the budgeted position.",
        ),
        # computed
        ColumnSpec(
            "tenure_months",
            "integer",
            "tempo_empresa_meses",
            description="Computed: snapshot to the end of the period, leavers to the leave date.",
        ),
    )
)

# The label column and the labels found in the published table.
LABEL_COLUMN = "BASE"
LABELS = {
    "snapshot": "QUADRO",
    "hires": "ADMITIDOS",
    "leavers": "DEMITIDOS",
    "movements": "MOVIMENTACOES",
    "contractors": "TERCEIROS",
    "budget": "ORCADO",
}
CONTRACTORS_PRESENT = "QUADRO-TERCEIROS"
CONTRACTORS_HIRED = "ADMITIDOS-TERCEIROS"
CONTRACTORS_LEFT = "DEMITIDOS-TERCEIROS"
CONTRACTOR_LABELS = (CONTRACTORS_PRESENT, CONTRACTORS_HIRED, CONTRACTORS_LEFT)
#: Contractors have no person id; those who left are told apart by period and name.
CONTRACTOR_KEYS = {CONTRACTORS_LEFT: ("period", "full_name")}
