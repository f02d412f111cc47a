"""Named batch plans over the driver's test tables: Spark side
(``registry``) and the equivalent SQL for a second engine (``oracle``)."""
