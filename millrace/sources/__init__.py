from .articles import article_lines, html_articles, read_wiki_xml
from .catalog import create_external_csv, create_external_orc, read_table, use_database
from .delimited import read_dataset, read_delimited
from .files import read_json_lines, read_lines, read_orc, read_parquet, row_range, widen
from .recompress import recompress_lines

__all__ = [
    "article_lines", "html_articles", "read_wiki_xml", "create_external_csv", "create_external_orc",
    "read_table", "use_database", "read_dataset", "read_delimited", "read_json_lines", "read_lines",
    "read_orc", "read_parquet", "row_range", "recompress_lines", "widen",
]
