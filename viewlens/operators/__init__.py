"""DataFrame -> DataFrame operators of the three customer pipelines and marts."""
