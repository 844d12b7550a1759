"""Fixed values that results depend on, kept in one place."""

# File types taken into the raw layer.
DOCUMENT_SUFFIXES = ("pdf", "docx", "doc", "pptx", "xlsx", "txt", "html")

# Metadata keys for each raw column, first present key wins.
METADATA_KEYS = {
    "content_type": ("Content-Type",),
    "author": ("dc:creator", "pdf:docinfo:creator", "Author"),
    "title": ("dc:title", "title"),
    "created": ("dcterms:created", "Creation-Date"),
    "language": ("dc:language", "language"),
    "num_pages": ("xmpTPg:NPages", "Page-Count"),
}

# Topic labels in rank order, the label of an empty text, and
# the author shown when none is known.
TOPICS = (
    "economia",
    "imóveis",
    "inflação",
    "mercado financeiro",
    "política",
    "tecnologia",
)
UNKNOWN_TOPIC = "desconhecido"
UNKNOWN_AUTHOR = "Desconhecido"

# Feature sizes, length rules and retrieval depth.
TF_BUCKETS = 512
EMBEDDING_DIMS = 768
MIN_CLEAN_CHARS = 50
MIN_SUMMARY_BYTES = 20
SHORT_TEXT_CHARS = 100
DEFAULT_TOP_K = 3
MART_BUCKETS = 4

# Prefix lengths, in characters, for models and previews that
# accept only so much text.
PREFIX_CHARS = {
    "embed": 2048,
    "summary": 1024,
    "classify": 512,
    "prompt": 12000,
    "chat_preview": 400,
    "table_preview": 200,
}

# The question-answering prompt.
PROMPT_HEAD = (
    "Você é um assistente especializado em análise de documentos em português brasileiro.\n"
    "Responda à pergunta com base nos trechos abaixo. Seja direto e objetivo.\n"
    "Use apenas informações presentes nos trechos. Se não houver informação suficiente, diga: "
    "'Não encontrei essa informação nos documentos.'\n\n"
    "Trechos:\n"
)
PROMPT_QUESTION = "\n\nPergunta: "
PROMPT_TAIL = "\n\nResposta:"

# Where each provider's reply keeps the answer. The first entry
# also serves any unknown provider.
REPLY_PATHS = {
    "ollama": "$.response",
    "openai": "$.choices[0].message.content",
    "gemini": "$.candidates[0].content.parts[0].text",
}
TEMPERATURE = 0.1

# The CSV tables of the ingest job, their files and the columns
# that hold timestamps.
CSV_TABLES = {
    "customers": ("olist_customers_dataset.csv", ()),
    "orders": (
        "olist_orders_dataset.csv",
        (
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
    ),
    "order_items": ("olist_order_items_dataset.csv", ("shipping_limit_date",)),
    "order_payments": ("olist_order_payments_dataset.csv", ()),
    "order_reviews": (
        "olist_order_reviews_dataset.csv",
        ("review_creation_date", "review_answer_timestamp"),
    ),
    "products": ("olist_products_dataset.csv", ()),
    "sellers": ("olist_sellers_dataset.csv", ()),
    "geolocation": ("olist_geolocation_dataset.csv", ()),
    "product_category_name_translation": ("product_category_name_translation.csv", ()),
}

# Characters that count as white space around and inside a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
