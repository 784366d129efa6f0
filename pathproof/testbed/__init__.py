"""The driver's tables read as pings, orders, events and tags, and the queries over them."""
