"""Tables of generated rows."""

from tidemark.model import APPEND, TableDef
from tidemark.sources.catalog.fields import fields

# Schemas and keys.
TABLES = {
    "my_table": TableDef("my_table", fields("id:long! name"), ("id",), mode=APPEND),
    "your_table": TableDef("your_table", fields("key! value"), ("key",), mode=APPEND),
}
