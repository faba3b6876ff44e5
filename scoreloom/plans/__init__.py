"""Jobs that chain operators, and the catalogue of registered queries."""
