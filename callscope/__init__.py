"""Call-centre analytics on Spark: coding rate, paid post call, value recovered, inbound drivers."""
