from textgraph.functions.numbers import ieee_divide, nan_to_null, parse_double
from textgraph.functions.text import file_name, folder_value, pack_key, tokenize_delims, tokenize_words, unpack_key

__all__ = [
    "file_name",
    "folder_value",
    "ieee_divide",
    "nan_to_null",
    "pack_key",
    "parse_double",
    "tokenize_delims",
    "tokenize_words",
    "unpack_key",
]
