"""Domains, limits, personal-data hints and patterns.

Everything here is data that results depend on. Operators take it as default arguments.
"""

from __future__ import annotations

from typing import NamedTuple

# Life-cycle states of a sale.
COMPLETED = "Concluída"
CANCELLED = "Cancelada"
IN_PROGRESS = "Em andamento"
STATUSES = (COMPLETED, CANCELLED, IN_PROGRESS)

# Sales channels and customer segments.
CHANNELS = ("Online", "Loja Física", "Televendas", "Parceiros")
SEGMENTS = ("Varejo", "Corporativo", "Governo", "SMB")

# Business limits.
HIGH_VALUE_ABOVE = 10000
CHURN_AFTER_DAYS = 90
TRAILING_MONTHS = 6
RFM_WEIGHTS = {"recency": 0.35, "frequency": 0.35, "monetary": 0.30}
NOT_INFORMED = "Não informado"

# Highest tolerated failure rate of a quality category, and its label in messages.
INTEGRITY, COMPLETENESS, BUSINESS = "integrity", "completeness", "business"
THRESHOLDS = {INTEGRITY: 0.0, COMPLETENESS: 0.05, BUSINESS: 0.0}
CATEGORY_LABELS = {INTEGRITY: "INTEGRIDADE", COMPLETENESS: "COMPLETUDE", BUSINESS: "NEGÓCIO"}

# Sampling and decision limits of the personal-data scan.
PII_MATCH_RATE = 0.20


class NameHint(NamedTuple):
    hint: str
    pii_type: str
    lgpd_class: str


class Pattern(NamedTuple):
    pii_type: str
    regex: str
    lgpd_class: str
    ignore_case: bool = False
    # A cheap regex that every match contains: text without it is not searched any further.
    needs: str | None = None


PERSONAL, SENSITIVE, NOT_PERSONAL = "dado_pessoal", "dado_pessoal_sensivel", "nao_pessoal"

# Column-name hints, first hit in this order wins.
NAME_HINTS = (
    NameHint("cpf", "CPF", PERSONAL),
    NameHint("cnpj", "CNPJ", PERSONAL),
    NameHint("email", "Email", PERSONAL),
    NameHint("e_mail", "Email", PERSONAL),
    NameHint("telefone", "Telefone", PERSONAL),
    NameHint("celular", "Telefone", PERSONAL),
    NameHint("fone", "Telefone", PERSONAL),
    NameHint("nome_cliente", "NomePessoa", PERSONAL),
    NameHint("nome_usuario", "NomePessoa", PERSONAL),
    NameHint("nome_completo", "NomePessoa", PERSONAL),
    NameHint("data_nascimento", "DataNascimento", PERSONAL),
    NameHint("data_nasc", "DataNascimento", PERSONAL),
    NameHint("nascimento", "DataNascimento", PERSONAL),
    NameHint("rg", "RG", PERSONAL),
    NameHint("cep", "CEP", PERSONAL),
    NameHint("endereco", "Endereco", PERSONAL),
    NameHint("logradouro", "Endereco", PERSONAL),
    NameHint("bairro", "Endereco", PERSONAL),
    NameHint("senha", "Senha", SENSITIVE),
    NameHint("password", "Senha", SENSITIVE),
    NameHint("hash_senha", "Senha", SENSITIVE),
    NameHint("saude", "DadoSaude", SENSITIVE),
    NameHint("diagnostico", "DadoSaude", SENSITIVE),
    NameHint("doenca", "DadoSaude", SENSITIVE),
    NameHint("raca", "OrigemEtnica", SENSITIVE),
    NameHint("etnia", "OrigemEtnica", SENSITIVE),
    NameHint("religiao", "CrencaReligiosa", SENSITIVE),
    NameHint("biometria", "DadoBiometrico", SENSITIVE),
    NameHint("impressao_digital", "DadoBiometrico", SENSITIVE),
)

_DIGITS = r"\d{3}"

# Content patterns, first one above the match rate in this order wins.
PATTERNS = (
    Pattern("CPF", r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b", PERSONAL, needs=_DIGITS),
    Pattern("CNPJ", r"\b\d{2}\.?\d{3}\.?\d{3}[/\\]?\d{4}-?\d{2}\b", PERSONAL, needs=_DIGITS),
    Pattern(
        "Email",
        r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}",
        PERSONAL,
        ignore_case=True,
        needs="@",
    ),
    Pattern("Telefone", r"(\+?55\s?)?(\(?[1-9]{2}\)?[\s.\-]?)(\d{4,5}[\s.\-]?\d{4})", PERSONAL, needs=_DIGITS),
    Pattern("CEP", r"\b\d{5}-?\d{3}\b", PERSONAL, needs=_DIGITS),
    Pattern("RG", r"\b\d{1,2}\.?\d{3}\.?\d{3}-?[\dxX]\b", PERSONAL, needs=_DIGITS),
)

# Inputs and label of the churn model.
CHURN_FEATURES = (
    "orders",
    "orders_per_month",
    "orders_per_month_6m",
    "total_revenue",
    "ticket_mean",
    "ticket_max",
    "category_count",
    "cancel_rate",
    "high_value_orders",
    "days_since_purchase",
    "rfm_score",
)
CHURN_LABEL = "churn_label"
# The label is a threshold on the first of these, and the second contains it.
LEAKING_FEATURES = ("days_since_purchase", "rfm_score")
