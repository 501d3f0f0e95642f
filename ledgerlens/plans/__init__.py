"""Named analyses (``analyses``), the star-schema mirrors that feed them
(``mirrors``), their (spark, sf_dir) wiring (``registry``) and independent SQL
statements of the same results (``oracle``)."""
