"""Declared constraints for the driver's tables (Parquet stores none).

Fixed values: the key and length declarations a user of the driver tables
makes, in the same shape as a relational schema's constraints.
"""

from quarry.operators.metadata import Constraints, ForeignKey

# Primary keys per table.
PRIMARY_KEYS = {
    "region": ("r_regionkey",),
    "nation": ("n_nationkey",),
    "customer": ("c_custkey",),
    "supplier": ("s_suppkey",),
    "part": ("p_partkey",),
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "events": ("event_id",),
    "documents": ("doc_id",),
    "embeddings": ("vec_id",),
    "pages": ("page_id",),
    "benchmark": ("item_id",),
    "labels": ("doc_id",),
    "conversations": ("conv_id", "turn"),
}

# Foreign keys (name, child table, child columns, parent table, parent columns).
FOREIGN_KEYS = [
    ForeignKey("fk_lineitem_orders", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    ForeignKey("fk_lineitem_part", "lineitem", ("l_partkey",), "part", ("p_partkey",)),
    ForeignKey("fk_lineitem_supplier", "lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
    ForeignKey("fk_orders_customer", "orders", ("o_custkey",), "customer", ("c_custkey",)),
    ForeignKey("fk_customer_nation", "customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    ForeignKey("fk_supplier_nation", "supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    ForeignKey("fk_nation_region", "nation", ("n_regionkey",), "region", ("r_regionkey",)),
    ForeignKey("fk_labels_documents", "labels", ("doc_id",), "documents", ("doc_id",)),
    ForeignKey("fk_events_customer", "events", ("user_id",), "customer", ("c_custkey",)),
]

# Declared maximum string lengths (varchar(n)).
LENGTHS = {
    "region": {"r_name": 25},
    "nation": {"n_name": 25},
    "customer": {"c_name": 25, "c_mktsegment": 10},
    "supplier": {"s_name": 25},
    "part": {"p_name": 55, "p_brand": 10, "p_type": 25},
    "orders": {"o_orderstatus": 1, "o_orderpriority": 15},
    "lineitem": {"l_returnflag": 1, "l_linestatus": 1},
    "events": {"event_type": 10},
    "documents": {"lang": 2, "source": 16},
    "pages": {"url": 2048},
    "conversations": {"role": 9},
}

# Columns declared NOT NULL (besides the primary keys).
NOT_NULL = {
    "region": ("r_name",),
    "nation": ("n_name", "n_regionkey"),
    "customer": ("c_name", "c_nationkey"),
    "supplier": ("s_name", "s_nationkey"),
    "part": ("p_name",),
    "orders": ("o_custkey", "o_orderdate"),
    "lineitem": ("l_partkey", "l_suppkey", "l_quantity"),
    "events": ("ts", "user_id", "event_type"),
    "documents": ("text",),
    "embeddings": ("embedding",),
    "pages": ("url", "html"),
    "benchmark": ("text",),
    "conversations": ("role",),
}

# Tables whose children must reference them (reverse check: parents with no child).
REVERSE_CHECKS = [("fk_lineitem_orders", "orders_without_lineitem")]

# All columns that must not be null: those of the primary keys first.
REQUIRED = {t: tuple(dict.fromkeys(key + NOT_NULL.get(t, ()))) for t, key in PRIMARY_KEYS.items()}

DRIVER_CONSTRAINTS = Constraints(primary_keys=PRIMARY_KEYS, foreign_keys=FOREIGN_KEYS, lengths=LENGTHS, not_null=NOT_NULL)
