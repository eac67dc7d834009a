"""Domain plans (composite operators D1-D28) and the registered queries that
run them on the driver tables."""
