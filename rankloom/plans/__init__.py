"""Physical-plan choices shared by the operators: join strategies, ranking and materialisation."""
