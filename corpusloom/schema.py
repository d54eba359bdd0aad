"""Columns of the corpus tables; whatever else a table carries is left out when it is read."""

COLUMNS = {
    "releases": "id source detail_id title date url body body_html grade",
    "page_cache": "url content id_content_type fw_guessed_charset bs4_encoding content_sha256 fetched_at",
    "body_origin": "url origin_url",
    "wayback_calls": "id ts kind url attempt timeout_budget outcome duration",
    "terratec_early__listing_1": "url title date date_str lang body body_html citation",
    "documents": "doc_id text lang source n_chars url title crawled_at",
    "source_tags": "source slug label ord lang tz dayfirst",
    "eval_items": "item_id task lang text answer",
}
#: Closed set of grades, best first.
GRADES = ("full", "teaser", "stub")

#: Types of the corpus' own tables, in the order of their columns.
TYPES = {
    "releases": "id long, source string, detail_id string, title string, date string, url string, body string, body_html string, grade string",
    "page_cache": "url string, content binary, id_content_type string, fw_guessed_charset string, bs4_encoding string, content_sha256 string, fetched_at double",
    "body_origin": "url string, origin_url string",
    "wayback_calls": "id long, ts double, kind string, url string, attempt int, timeout_budget double, outcome string, duration double",
}
