"""Fixed values.

Every literal below must equal the value the original job uses, because it
either selects rows or appears in the output.  They are kept together, in
their natural order, and are not derived from anything.
"""

# --- fixed values: row selection -------------------------------------------
PAID_STATUS = "Paid"
POSTAL_QUESTION = "CEP"
REJECTED_ANSWERS = ("true", "null")
SERVICE_SHOP_EVENT_ID = 211
LOCAL_OFFSET_HOURS = -3
FIELD_ID_COLLATION = "UNICODE_CI_AI"
SHIRT_STOCK_NAMES = ("Tamanho da Camisa", "Shirt Size")
KIT_PICKUP_STOCK_NAMES = ("Retirada de Kit", "Kit Pickup")
DEFAULT_ROWS_PER_BATCH = 10_000_000

# --- fixed values: report text ---------------------------------------------
NO_PAYMENT_LABEL = "Cortesia"
PAYMENT_LABELS = {"Boleto": "Boleto", "CreditCard": "Cartão", "Pix": "Pix"}
AGE_BANDS = (
    (0, 20, "até 20 anos"),
    (20, 30, "de 21 a 30 anos"),
    (30, 40, "de 31 a 40 anos"),
    (40, 50, "de 41 a 50 anos"),
    (50, 60, "de 51 a 60 anos"),
)
OVER_60_LABEL = "acima de 60 anos"
NEGATIVE_AGE_LABEL = "até 20 anos"
REFUNDABLE_MARK = "X"

# --- fixed values: postal codes ---------------------------------------------
POSTAL_DIGITS = 8
POSTAL_PAD = "0"
POSTAL_PREFIX_LEN = 5

# --- fixed values: lookup providers, in fallback order ----------------------
# name, JSON field whose value rejects the answer, rejecting value (None = the
# answer is rejected when the field holds anything but null).
PROVIDERS = (
    ("brasilapi", "errors", None),
    ("viacep", "type", "validation_error"),
    ("apicep", "code", "not_found"),
)
ACCEPT_KEY = "cep"
# Request URL of each provider; the code (NNNNN-NNN) replaces the placeholder.
URL_PLACEHOLDER = "replace_cep"
PROVIDER_URLS = {
    "brasilapi": "https://brasilapi.com.br/api/cep/v1/replace_cep",
    "viacep": "https://viacep.com.br/ws/replace_cep/json/",
    "apicep": "https://cdn.apicep.com/file/apicep/replace_cep.json",
}
ADDRESS_FIELDS = ("cep", "state", "city", "neighborhood", "street", "service")

# --- fixed values: display names --------------------------------------------
PARTICIPANT_DISPLAY_NAMES = {
    "batch_number": "batch_number",
    "item_id": "itemID",
    "order_id": "pedidoID",
    "purchase_date": "data de compra",
    "participant": "participante",
    "correlated_item_id": "itemId correlacionado",
    "correlated_participant": "participante correlacionado",
    "edition": "edição",
    "event": "evento",
    "race": "prova",
    "ticket": "ticket",
    "ticket_type": "tipo do ticket",
    "ticket_tracking": "rastreio do ticket",
    "coupon": "cupom",
    "payment_method": "forma de pgto",
    "email": "email",
    "phone": "telefone",
    "cpf": "CPF",
    "birth_date": "nascimento",
    "age": "idade",
    "age_band": "faixa etária",
    "shirt": "camisa",
    "refundable": "reembolsável",
    "pickup_day": "dia da retirada",
    "pickup_hour": "hora da retirada",
}
REPORT_ADDRESS_NAMES = {
    "cep": "cep",
    "state": "UF",
    "city": "cidade",
    "neighborhood": "bairro",
    "street": "logradouro",
}
REPORT_STAMP = "%Y%m%d_%H%M"
PROFILE_LABELS = {
    "total": "total de ceps",
    "with_underscore": "ceps com underline",
    "without_hyphen": "ceps sem hifen",
    "ok": "ceps ok",
    "too_short": "ceps com menos de 8 dígitos",
    "too_long": "ceps com mais de 8 dígitos",
    "peculiar": "ceps com tratamento especial",
}
COUNTER_DISPLAY_NAMES = {
    "brasilapi_errors": "brasil api errors",
    "viacep_errors": "viacep errors",
    "apicep_errors": "apicep errors",
}
