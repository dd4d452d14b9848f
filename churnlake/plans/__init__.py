"""Plan shapes shared by the operators: frozen frames, checked broadcasts, ordering."""
