"""Every covered operator as a query on the star-schema tables, with its SQL."""
