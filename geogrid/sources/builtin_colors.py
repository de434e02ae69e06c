"""Builtin colour tables: control points between which colours are linear.

Tables of up to 200 rows are here; longer ones are linear between the points given, or come from a file by
``tables.read_colormap``.
"""

from __future__ import annotations

#: Fixed values. name: (positions, colours r g b or r g b a of 0..255).
TABLES: dict[str, tuple[list[float], list[tuple[int, ...]]]] = {
    "rainbow": ([0, 0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1], [(0, 0, 128), (0, 0, 255), (0, 128, 255), (0, 255, 255), (128, 255, 128), (255, 255, 0), (255, 128, 0), (255, 0, 0), (128, 0, 0)]),
    "ylorrd": ([0, 0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1], [(255, 255, 204), (255, 237, 160), (254, 217, 118), (254, 178, 76), (253, 141, 60), (252, 78, 42), (227, 26, 28), (189, 0, 38), (128, 0, 38)]),
    "idl_rainbow": ([0, 1, 28, 29, 85, 142, 143, 144, 145, 198, 200, 254, 255], [(124, 0, 255), (124, 0, 255), (3, 0, 255), (0, 2, 255), (0, 254, 255), (1, 255, 0), (5, 255, 0), (13, 255, 0), (14, 255, 0), (253, 255, 0), (255, 248, 0), (255, 5, 0), (255, 5, 0)]),
    "MIRS_RainRate": (
        [0, 1, 5, 6, 11, 12, 17, 18, 23, 32, 33, 39, 46, 56, 57, 89, 91, 103, 121, 122, 136, 137, 174, 175, 201, 255],
        [(0, 0, 0), (255, 184, 255), (255, 0, 255), (255, 0, 255), (0, 0, 255), (0, 51, 255), (0, 255, 226), (0, 255, 226), (0, 254, 189), (5, 254, 0), (67, 254, 0), (117, 254, 0), (200, 255, 0), (255, 255, 0), (255, 255, 0), (255, 97, 0), (255, 95, 0), (255, 72, 0), (255, 0, 0), (255, 21, 31), (255, 165, 248), (244, 163, 249), (193, 255, 197), (191, 253, 179), (255, 255, 182), (255, 182, 179)],
    ),
    "abi_l2_modified_cloud_top": (
        [0, 17.000001, 17.000002, 34.000001, 34.000002, 51.000001, 51.000002, 68.000001, 68.000002, 85.000001, 85.000002, 102.000001, 102.000002, 119.000001, 119.000002, 136.000001, 136.000002, 153.000001, 153.000002, 170.000001, 170.000002, 187.000001, 187.000002, 204.000001, 204.000002, 221.000001, 221.000002, 238.000001, 238.000002, 255],
        [(127, 0, 127), (127, 0, 127), (150, 75, 20), (150, 75, 20), (255, 171, 127), (255, 171, 127), (255, 127, 0), (255, 127, 0), (255, 255, 50), (255, 255, 50), (220, 220, 40), (220, 220, 40), (58, 135, 0), (58, 135, 0), (75, 175, 0), (75, 175, 0), (100, 200, 130), (100, 200, 130), (112, 219, 147), (112, 219, 147), (120, 120, 240), (120, 120, 240), (150, 150, 245), (150, 150, 245), (180, 180, 250), (180, 180, 250), (225, 225, 255), (225, 225, 255), (255, 255, 255), (255, 255, 255)],
    ),
    "viirs_edr_flood_water_detection": (
        [14, 15, 16, 17, 18, 20, 27, 30, 31, 88, 100, 120, 121, 130, 131, 140, 141, 150, 151, 160, 161, 170, 171, 180, 181, 190, 191, 200, 201],
        [(0, 0, 0), (0, 0, 100), (196, 162, 114), (196, 162, 114), (0, 0, 255), (255, 255, 255), (0, 255, 255), (200, 200, 200), (100, 100, 100), (180, 0, 230), (50, 255, 100), (50, 255, 100), (0, 255, 0), (0, 255, 0), (200, 255, 0), (200, 255, 0), (255, 255, 150), (255, 255, 150), (255, 255, 0), (255, 255, 0), (255, 200, 0), (255, 200, 0), (255, 150, 50), (255, 150, 50), (255, 100, 0), (255, 100, 0), (255, 0, 0), (255, 0, 0), (0, 0, 0)],
    ),
}

#: Fixed values of step tables: name | limits between steps, from the first to the last | a colour for each step.
STEPS = """
cloud_phase_steps | -0.5 0.5 1.5 2.5 3.5 4.5 5.5 | 0,0,0 2,188,252 1,251,0 0,103,1 250,249,0 246,0,253
snow_cover_steps | -0.5 0.5 1.5 2.5 3.5 4.5 | 0,0,0 45,104,196 46,111,64 211,211,211 250,250,250
cloud_layer_steps | -0.5 0.5 1.5 2.5 3.5 4.5 5.5 6.5 7.5 | 0,0,0 255,160,0 255,255,0 0,140,0 0,255,255 255,110,200 0,0,255 90,0,90
cloud_fraction_steps | 0 0.125 0.375 0.624 1 | 0,0,0 0,0,184 42,135,255 255,255,255
veg_index_steps | 0 0.06 0.2921 0.35 0.40999 0.47 0.527 0.586 0.645 0.704 0.762 0.81 0.88 0.939 0.99599 1 | 235,235,235 202,108,32:255,222,104 126,156,44 150,182,19 117,170,0 103,161,0 82,148,0 61,134,1 28,115,1 0,95,1 0,72,0 2,55,1 0,41,1 1,19,1 235,235,235:0,0,0
"""
#: A step ends so far below the start of the next one.
STEP_GAP = {"veg_index_steps": 0.00001, "cloud_fraction_steps": 0.00001}


def _step_tables() -> dict[str, tuple[list[float], list[tuple[int, ...]]]]:
    out = {}
    for line in STEPS.strip().splitlines():
        name, limits, colors = (x.strip() for x in line.split("|"))
        edges, gap = [float(x) for x in limits.split()], STEP_GAP.get(name, 0.0001)
        values: list[float] = []
        rows: list[tuple[int, ...]] = []
        for k, color in enumerate(colors.split()):
            ends = [tuple(int(x) for x in c.split(",")) for c in color.split(":")]
            values += [edges[k] + (gap if k else 0.0), edges[k + 1]]
            rows += [ends[0], ends[-1]]
        out[name] = (values, rows)
    return out


def color_tables() -> dict[str, tuple[list[float], list[tuple[int, ...]]]]:
    """All builtin tables by name."""
    return {**TABLES, **_step_tables()}
