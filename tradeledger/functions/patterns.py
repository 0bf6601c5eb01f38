"""Personal-data vocabulary: name terms and value patterns."""

from __future__ import annotations

# Terms and patterns that decide the class of a column.
SENSITIVE_TERMS = ["health", "saude", "biometric", "biometrico"]
PERSONAL_TERMS = [
    "email", "cpf", "cnpj", "phone", "telefone", "name", "nome", "address", "endereco",
    "birth_date", "data_nascimento", "ip", "user_id", "customer_id", "document", "documento",
    "gender", "genero",
]
INDIRECT_TERMS = ["city", "state", "zip", "postal", "birth", "device", "session"]
VALUE_PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "cpf": r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b",
    "cnpj": r"\b\d{2}\.?\d{3}\.?\d{3}/?\d{4}-?\d{2}\b",
    "phone": r"(?:\+?55\s?)?(?:\(?\d{2}\)?\s?)?(?:9?\d{4})-?\d{4}",
    "ip": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
}
# What any match must have: a minimum length and, for two patterns, a character. A cheap test
# that spares the regular expression on most cells and never changes its answer.
NEEDS = {"email": (6, "@"), "cpf": (11, None), "cnpj": (14, None), "phone": (8, None), "ip": (7, ".")}
DIRECT_HINTS = ["cpf", "email", "phone", "telefone", "document", "nome", "name", "cnpj"]
REMOVE_SENSITIVE_TOKENS = ["biometric", "biometrico"]
REMOVE_PERSONAL_TOKENS = ["cpf", "cnpj", "document", "documento"]

# Value patterns are tried in this order; the first hit decides.
PATTERN_CLASS = {
    "email": "personal_data",
    "cpf": "personal_data",
    "cnpj": "personal_data",
    "phone": "personal_data",
    "ip": "indirect_identifier",
}
