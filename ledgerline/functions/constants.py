"""Fixed values of the order model.

These must equal the source system's values for results to be right, so they
are stated plainly here and nowhere else.
"""

# --- fixed values: status master (type, status, order) --------------------
ORDER_TYPE = "order"
ITEM_TYPE = "item"
STATUS_MASTER = (
    ("order", "Cancelled", 0),
    ("order", "Initial", 10),
    ("order", "In-Progress", 20),
    ("order", "Complete", 30),
    ("item", "Cancelled", 0),
    ("item", "Initial", 1000),
    ("item", "Shipped", 2000),
    ("item", "Delivered", 3000),
)
CANCELLED = "Cancelled"
DELIVERED = "Delivered"
# --- end of fixed values ----------------------------------------------------

# Names of the version-history columns.
START_AT = "__START_AT"
END_AT = "__END_AT"
CURRENT = "__CURRENT"
