"""The published result lists of one real run over 10,106 incidents."""

TOTAL = 10106

AREAS = [
    ("La Candelaria", 3248, "ALTO"),
    ("Laureles-Estadio", 1594, "ALTO"),
    ("Belén", 1008, "ALTO"),
    ("El Poblado", 954, "ALTO"),
    ("Castilla", 562, "ALTO"),
    ("Guayabal", 546, "ALTO"),
    ("Aranjuez", 437, "MEDIO"),
    ("La América", 391, "MEDIO"),
    ("Robledo", 376, "MEDIO"),
    ("Buenos Aires", 270, "MEDIO"),
    ("Villa Hermosa", 162, "MEDIO"),
    ("Manrique", 126, "BAJO"),
    ("Doce de Octubre", 121, "BAJO"),
    ("San Javier", 99, "BAJO"),
    ("Santa Cruz", 68, "BAJO"),
    ("Popular", 44, "BAJO"),
    ("San Antonio de Prado", 27, "BAJO"),
    ("Santa Elena", 26, "BAJO"),
    ("San Cristóbal", 24, "BAJO"),
    ("Desconocida", 12, "BAJO"),
    ("Altavista", 8, "BAJO"),
    ("Palmitas", 3, "BAJO"),
]

MODALITIES = [
    ("Atraco", 4156),
    ("No especificado", 3399),
    ("Descuido", 897),
    ("Raponazo", 577),
    ("Cosquilleo", 566),
    ("Engaño", 156),
    ("Halado", 152),
    ("Llave maestra", 67),
    ("Rompimiento de ventana", 63),
    ("Suplantación", 23),
    ("Comisión de delito", 19),
    ("Rompimiento cerraduta", 12),
    ("Tóxico o agente químico", 9),
    ("Abuso de confianza", 5),
    ("Paquete chileno", 2),
    ("Violencia intrafamiliar", 2),
    ("Enfrentamiento con la fuerza pública", 1),
]

HOURS = [
    330, 187, 188, 150, 153, 150, 220, 272, 308, 404, 571, 575,
    549, 501, 475, 710, 766, 555, 559, 600, 631, 540, 457, 255,
]

SHIFTS = [("Tarde", 3556), ("Mañana", 2350), ("Noche", 2330), ("Madrugada", 1870)]

WEAPONS = [
    ("Arma de fuego", 3581),
    ("No", 2230),
    ("Arma cortopunzante", 2031),
    ("No especificado", 1617),
    ("Objeto contundente", 572),
    ("Escopolamina", 73),
    ("Llave maestra", 1),
    ("Perro", 1),
]
