"""The hand-computed twelve-line feed (header + 12 lines)."""

HEADER = (
    "adshex;flight_id;latitude;longitude;altitude;speed;track;squawk;type;timestamp;name;"
    "other_names1;other_names2;n_number;serial_number;mfr_mdl_code;mfr;model;year_mfr;"
    "type_aircraft;agency"
)

LINES = [
    "A1;F1;33.5;-117.25;5000;100;90;0453;C182;2015-08-18T07:58:54Z;NAME;;;N1;S1;2072738;CESSNA;182T;2006;4;dhs",
    "A2;F2;33.5;-117.25;5100;200;91;4401;C182;2015-08-18T07:58:59Z;NAME;;;N2;S2;2072738;CESSNA;182T;2006;4;fbi",
    "A1;F1;33.6;-117.25;5200;120;92;4401;C182;2015-08-18T07:59:04Z;NAME;;;N1;S1;2072738;CESSNA;182T;2006;4;dhs",
    "A3;F3;33.5;-117.25;5300;210;93;4401;C182;2015-08-18T07:59:09Z;NAME;;;N3;S3;2072738;CESSNA;182T;2006;4;fbi",
    "A1;F1;33.7;-117.25;5400;x;94;4401;C182;2015-08-18T07:59:14Z;NAME;;;N1;S1;2072738;CESSNA;182T;2006;4;dhs",
    "A4;F4;33.5;-117.25;5500;90;95;4401;C182;2015-08-18T07:59:19Z;NAME;;;N4;S4;2072738;CESSNA;182T;2006;4;doj",
    "A2;F2;33.5;-117.25;5600;150;96;4401;C182;2015-08-18T07:59:24Z;NAME;;;N2;S2;2072738;CESSNA;182T;2006;4;fbi",
    "A2;F2;33.5;-117.25;5700;160;97;4401;C182;2015-08-18T07:59:29Z;NAME;;;N2;S2;2072738;CESSNA;182T;2006;4;fbi",
    "A5;F5;33.5;-117.25;5800;80;98;4401;C182;2015-08-18T07:59:34Z;NAME;;;N5;S5;2072738;CESSNA;182T;2006;4;dhs",
    "A5;F5;33.5;-117.25;5900;85;99;4401;C182;2015-08-18T07:59:39Z;NAME;;;N5;S5;2072738;CESSNA;182T;2006;4;",
    "A1;F1;33.5;-117.25;6000;130;100;4401;C182;2015-08-18T07:59:44Z;NAME;;;N1;S1;2072738;CESSNA;182T;2006;4;DHS",
    "A3;F3;33.5;-117.25;6100; 170;101;4401;C182;2015-08-18T07:59:49Z;NAME;;;N3;S3;2072738;CESSNA;182T;2006;4;fbi",
]


def write_feed(path: str, lines=LINES, header: str = HEADER) -> str:
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(header + "\n")
        for line in lines:
            fh.write(line + "\n")
    return path
