"""Text kernels of the law: citations, case numbers, parties, provisions, treatment, versions. Pure functions over one text, and the column or batch forms that run them."""
