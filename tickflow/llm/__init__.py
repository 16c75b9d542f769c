"""Training-data operators: one module per operator, plus the registered queries.

Nothing else in the library imports this subpackage; it imports only the
library's general helpers (session folders, distributed row positions).
"""
