"""The sample star-schema tables seen as sixteen change feeds, and the queries over them."""
