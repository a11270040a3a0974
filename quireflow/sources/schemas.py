"""Schemas of the stored tables. Missing text is the empty string, not null."""

RAW = "id long, source string, source_id string, title_raw string, author_raw string, publisher string, pub_year string, isbn string, category string, url string, fetched_at string"
BOOKS = "id long, title string, title_key string, edition string, volume string, author string, publisher string, pub_year string, isbn string, category string, sources string, n_sources long, aliases string, confidence double"
MEMBERS = "book_id long, raw_id long"
STATE = "source string, task_key string, done long, pages long, items long, updated_at string"
LEGACY = "title string, author string, source string"
SCAN_COLUMNS = ("id", "source", "source_id", "title_raw", "author_raw", "publisher", "pub_year", "isbn", "category")
#: Columns that a listing parser gives; the sink adds id and fetched_at.
LISTING = ("source", "source_id", "title_raw", "author_raw", "publisher", "pub_year", "isbn", "category", "url")
